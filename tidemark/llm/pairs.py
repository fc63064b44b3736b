"""Broken prompt and response pairs.

Each answer gets at most one defect: empty, refusal, copied_question,
other_language or truncated, looked for in this order.
"""

from __future__ import annotations

import heapq
import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm.labelled import COMMON

# What stands for a missing answer.
PLACEHOLDERS = {"null", "none", "nan", "n/a", "na", "nil", "tbd", "todo", "undefined", "empty", "no answer", "no response", "error", "-", "--", "...", "?"}
OPEN, CLOSE = "([{“„«‹", ")]}”“»›"
PAIRS = {"(": ")", "[": "]", "{": "}", "“": "”", "„": "“”", "«": "»", "‹": "›"}
QUOTED = re.compile(r'"[^"\n]*"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»')
# signs that don't show, and letters outside the Latin ones
HIDDEN = re.compile("[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Cf", "Cc") and chr(c) not in "\n\t\r") + "]")
FOREIGN = re.compile(r"[^\W\d_\u0000-\u024f]")
# what the parser looks at: list marks, fences, emphasis, tags, quotation marks and brackets
TOKEN = re.compile(r"(?P<mark>(?<![^\n ])(?:\(?\d{1,2}|\(?[a-z])\)\s)|```|\*\*|<(?P<end>/?)(?P<tag>[a-zA-Z]\w*)[^<>]*>|[\"(\[{“„«‹)\]}”»›]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")

# Refusal grammars: who declines, how, and what; a sentence with all three in order is a refusal.
# The words of each part in five languages.
_DO = r"(?:give|provid\w*|offer\w*|make|shar\w*|express\w*|issu\w*|form)"
_WHAT = r"(?:advice|recommendation\w*|opinion\w*|guidance|answer\w*|view\w*|position|assessment|verdict|suggestion\w*|response)"
_THIS = r"(?:this|that|these|those|such|your|any|it|the (?:request|question)|requests?|questions?)"
_NOT = r"(?:cannot|can ?not|can['’]t|could not|couldn['’]t|won['’]t|will not|wouldn['’]t|would not|am (?:not able|unable|not permitted|not allowed|not in a position)(?: to)?|['’]m (?:not able|unable|not permitted|not allowed|not in a position)(?: to)?|may not|must not|(?:would |['’]d )?(?:rather|prefer) not(?: to)?|do not|don['’]t)"
_TURN = r"(?:(?:must|need to|have to|has to|will|shall|would like to|['’]ll|am going to|am obliged to)\s+(?:\w+ )?(?:decline|refuse|pass|abstain)|decline|refuse|abstain)"
ENGLISH = [
    r"\b(?:I|we)\b[^.!?\"]*?\b(?:do not|don['’]t|not|would not|wouldn['’]t)\s+(?:feel |be )?comfortable\b",
    rf"\b(?:I|we|this assistant|the assistant|this model)\b[^.!?\"]*?\b{_NOT}\s+(?:\w+ ){{0,2}}?{_DO}\b[^.!?\"]{{0,40}}?\b{_WHAT}",
    rf"\b(?:I|we|this assistant|the assistant|this model)\b[^.!?\"]*?\b{_NOT}\s+(?:\w+ ){{0,2}}?(?:help|assist|answer|comment|advise|respond|engage)\b(?:\s+(?:\w+ ){{0,2}}?(?:with|on|to|you)?\s*(?:\w+ )?{_THIS}|\s*[,.!;]|\s*$|\s+(?:you|anyone))",
    rf"\b(?:I|we|this assistant|the assistant|this model)\b[^.!?\"]*?\b{_NOT}\s+(?:\w+ ){{0,2}}?(?:tell|say to|instruct)\s+(?:you|anyone|people|users)\b",
    rf"\b(?:I|we|this assistant|the assistant|this model)\b[^.!?\"]*?\b{_NOT}\s+(?:\w+ ){{0,2}}?recommend\b[^.!?\"]{{0,30}}?\b(?:specific|individual|particular|any)\b",
    rf"\b(?:I|we|this assistant|the assistant|this model)\b[^.!?\"]*?\b{_TURN}\b(?:\s+(?:to\s+)?(?:{_DO}|answer|comment|advise|recommend|respond|take|{_THIS})|\s*[.!,;]|\s*$)",
]
OTHERS = [
    # German
    r"\bich\b[^.!?]*?\bkein\w*\s+(?:\w+\s+){0,2}?(?:\w*empfehlung\w*|meinung|rat|ratschl\w+|auskunft|urteil|einschätzung|antwort|beratung)",
    r"\b(?:kann|darf|möchte|will|werde|muss)\b[^.!?]*?\b(?:mich|ich|wir)\b[^.!?]*?\bnicht\b[^.!?]*?\b(?:äußern|helfen|beantworten|beraten|empfehlen|antworten)",
    r"\bich\b[^.!?]*?\b(?:muss|möchte|lehne)\b[^.!?]*?\b(?:ablehnen|verzichten|enthalten|ab)\b",
    r"\b(?:anfrage|frage|bitte|wunsch)\b[^.!?]*?\b(?:muss|kann|darf)\b[^.!?]*?\bich\b[^.!?]*?\b(?:ablehnen|nicht)\b",
    # French
    r"\bje\s+(?:ne\s+)?(?:peux|puis|suis|dois|souhaite|préfère|veux)\b[^.!?]*?\b(?:conseil\w*|recommand\w*|avis|prononcer|répondre|aider|décliner|refuser|opinion)",
    r"\bcette demande\b[^.!?]*?\b(?:permis|autoris\w+|cadre|possible)",
    r"\b(?:m['’]est|il m['’]est)\b[^.!?]*?\b(?:impossible|interdit|pas permis)",
    # Spanish
    r"\bno\s+(?:puedo|debo|me es posible|me está permitido|estoy autorizad\w|quiero|voy a)\b[^.!?]*?\b(?:asesor\w*|recomend\w*|consejo\w*|opin\w*|ayudar\w*|respond\w*|contestar)",
    r"\bprefiero no\b[^.!?]*?\b(?:opinar|pronunciarme|responder|recomendar|dar|comentar)",
    r"\b(?:debo|tengo que|he de)\s+(?:rechazar|declinar|abstenerme|negarme)",
    r"\besta (?:petición|solicitud|consulta)\b[^.!?]*?\b(?:permitid\w|fuera|queda|excede)",
    # Italian
    r"\bnon\s+(?:posso|mi è (?:permesso|possibile|consentito)|sono autorizzat\w|intendo|voglio)\b[^.!?]*?\b(?:consigli\w*|raccomand\w*|parere|opinion\w*|aiutar\w*|risponder\w*|pronunciar\w*|esprimer\w*)",
    r"\bpreferisco non\b[^.!?]*?\b(?:esprimer\w*|pronunciar\w*|risponder\w*|dare|commentare)",
    r"\b(?:devo|debbo)\s+(?:declinare|rifiutare|astenermi|rinunciare)",
    r"\bquesta richiesta\b[^.!?]*?\b(?:permess\w|consentit\w|fuori|esula)",
]
REFUSAL = re.compile("|".join(f"(?:{p})" for p in ENGLISH + OTHERS), re.IGNORECASE)
SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+")
LANGUAGES = {lang: set(words.split()) for lang, words in COMMON.items()}
# a word of several languages counts for each in part
WEIGHTS = {w: [(lang, 1 / sum(w in known for known in LANGUAGES.values())) for lang, known in LANGUAGES.items() if w in known] for known in LANGUAGES.values() for w in known}
SCRIPTS = ("LATIN", "CYRILLIC", "GREEK", "ARABIC", "HEBREW", "CJK", "HIRAGANA", "KATAKANA", "HANGUL", "THAI", "DEVANAGARI")


def visible(text: str | None) -> str:
    """The text without blanks at its ends and without signs that don't show."""
    text = text or ""
    # plain text, as nearly all is, needs no look at each sign
    if not (text.isascii() and text.replace("\n", "").isprintable()):
        text = HIDDEN.sub("", text).replace("\u00a0", " ")
    return text.strip()


def is_empty(text: str | None) -> bool:
    t = visible(text)
    return not re.search(r"[^\W_]", t) or t.strip(" .\"'`()[]{}<>").lower() in PLACEHOLDERS


def is_refusal(text: str) -> bool:
    """Whether a sentence of the writer's own, outside quotations, declines to answer."""
    return any(REFUSAL.search(s) for s in SENTENCE.split(QUOTED.sub(" ", text)))


def tiled(a: list[str], b: list[str], least: int = 5) -> int:
    """Words of `a` covered by greedy string tiling with `b`: the longest common runs first, of equal ones the first, none shorter than `least`, no word twice.

    Each maximal run is found once, from the hashed runs of `least` words; one
    that an earlier tile cut goes back into the heap as what is left of it.
    """
    starts: dict[tuple, list[int]] = {}
    for j in range(len(b) - least + 1):
        starts.setdefault(tuple(b[j : j + least]), []).append(j)
    heap = []
    for i in range(len(a) - least + 1):
        for j in starts.get(tuple(a[i : i + least]), ()):
            if i and j and a[i - 1] == b[j - 1]:
                continue
            k = least
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            heap.append((-k, i, j))
    heapq.heapify(heap)
    used_a, used_b, covered = bytearray(len(a)), bytearray(len(b)), 0
    while heap:
        k, i, j = heapq.heappop(heap)
        k = -k
        if not any(used_a[i : i + k]) and not any(used_b[j : j + k]):
            used_a[i : i + k] = used_b[j : j + k] = b"\1" * k
            covered += k
            continue
        free = 0
        for x in range(k + 1):
            if x < k and not used_a[i + x] and not used_b[j + x]:
                free += 1
                continue
            if free >= least:
                heapq.heappush(heap, (-free, i + x - free, j + x - free))
            free = 0
    return covered


def is_copy(answer: str, prompt: str, share: float = 0.6) -> bool:
    """Whether most of the answer is taken from the prompt and most of what the prompt says is in it."""
    a, b = re.findall(r"\w+", answer.lower()), re.findall(r"\w+", prompt.lower())
    if len(a) < 5 or not b:
        return False
    least, known = share * max(len(a), len(b)), set(b)
    # tiles cover no other words than those in both
    return sum(w in known for w in a) >= least and tiled(a, b) >= least


def script_of(text: str) -> str | None:
    """The script most letters are in."""
    foreign = FOREIGN.findall(text)
    if not foreign:
        return "LATIN" if any(map(str.isalpha, text)) else None
    counts: dict[str, int] = {"LATIN": sum(map(str.isalpha, text)) - len(foreign)}
    for c in foreign:
        name = "LATIN" if c < "ɐ" else unicodedata.name(c, "").split(" ")[0]
        counts[name] = counts.get(name, 0) + 1
    return max(counts, key=lambda s: (counts[s], s))


def language_of(text: str) -> str | None:
    """One of five languages by its function words, outside quotations; another script by its name; None if unclear."""
    own = QUOTED.sub(" ", text)
    script = script_of(own)
    if script and script != "LATIN":
        return script
    scores = dict.fromkeys(LANGUAGES, 0.0)
    for word in WORD.findall(own.lower()):
        for part in (word,) if word.isalpha() else re.split("['’]", word):
            for lang, weight in WEIGHTS.get(part, ()):
                scores[lang] += weight
    ranked = sorted(((v, lang) for lang, v in scores.items()), reverse=True)
    (first, lang), (second, _) = ranked[0], ranked[1]
    return lang if first >= 1.5 and first >= 1.2 * second + 0.5 else None


UNCLOSED = {"br", "hr", "img", "input", "p", "li"}


def is_truncated(text: str) -> bool:
    """Whether the text breaks off: a fence, bracket, quotation, emphasis or tag stays open, a list mark has no item, or the last sentence doesn't end.

    One pass with a stack over fences, brackets, quotations, `**` and the tags
    that begin a line; list marks like `1)` and `a)` close nothing, a `"` after
    a digit with no quotation open is an inch mark, and what is inside a fence
    isn't parsed.
    """
    t = visible(text)
    stack: list[str] = []

    def close(name: str) -> None:
        """Take the innermost `name` off the stack; what is open inside it stays open."""
        stack.reverse()
        stack.remove(name)
        stack.reverse()

    for m in TOKEN.finditer(t):
        c, i = m[0], m.start()
        if c == "```":
            if stack and stack[-1] == "```":
                stack.pop()
            else:
                stack.append("```")
        elif (stack and stack[-1] == "```") or m["mark"]:
            continue
        elif m["tag"]:
            name = "<" + m["tag"].lower()
            if m["end"]:
                if name in stack:
                    close(name)
            elif not t[t.rfind("\n", 0, i) + 1 : i].strip() and not c.endswith("/>") and name[1:] not in UNCLOSED:
                stack.append(name)
        elif c == "**":
            if "**" in stack and i and not t[i - 1].isspace():
                close("**")
            elif (not i or not t[i - 1].isalnum()) and i + 2 < len(t) and not t[i + 2].isspace() and t[i + 2] != "*":
                stack.append("**")
        elif c == '"':
            if stack and stack[-1] == '"':
                stack.pop()
            elif '"' in stack or not i or not t[i - 1].isdigit():
                stack.append('"')
        elif stack and c in PAIRS.get(stack[-1], ""):
            stack.pop()
        elif c in PAIRS:
            stack.append(c)
    if stack:
        return True
    if t.endswith("```"):
        return False
    if re.search(r"\n\s*(?:[-*•]|\(?(?:\d{1,2}|[a-z])[.)])$", t):
        return True
    body = re.sub(r"(?:</\w+>\s*|[\"'”’»)\]}*_`\s])+$", "", t)
    if not body:
        return False
    if re.search(r"(?:\.\.+|…)$", body):
        return True
    return body[-1] not in ".!?。！？"


def defect(answer: str | None, prompt: str | None, error: str | None = None, action: str | None = None) -> str | None:
    """The kind of defect, or None.

    An answer that is nothing but the error's message is empty; one that is
    nothing but the action given is a short answer. Without a prompt, copies
    and other languages can't be told and aren't reported.
    """
    text = visible(answer)
    if is_empty(text):
        return "empty"
    if error and text.casefold() == visible(error).casefold():
        return "empty"
    if action and text.strip(".!").casefold() == visible(action).casefold():
        return None
    if is_refusal(text):
        return "refusal"
    if prompt and is_copy(text, prompt):
        return "copied_question"
    if prompt:
        asked, given = language_of(prompt), language_of(text)
        if asked and given and asked != given:
            return "other_language"
    return "truncated" if is_truncated(text) else None


def defective_pairs(df: DataFrame, key: str, prompt: str, answer: str, error: str | None = None, action: str | None = None) -> DataFrame:
    """(key, defect_type): the rows of `df` whose answer is none, read with their error and action if these columns are named. Repeated rows each come out."""
    kind = df.schema[key].dataType.simpleString()
    text = lambda v: v if isinstance(v, str) else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [defect(*map(text, row)) for row in zip(f["a"], f["p"], f["e"], f["act"], strict=True)]
            out = pd.DataFrame({"key": f["k"], "defect_type": found})
            yield out[out["defect_type"].notna()]

    column = lambda c: "cast(null as string)" if c is None else f"`{c}`"
    rows = df.selectExpr(f"`{key}` as k", f"`{prompt}` as p", f"`{answer}` as a", f"{column(error)} as e", f"{column(action)} as act")
    return rows.mapInPandas(run, f"key {kind}, defect_type string").withColumnRenamed("key", key)
