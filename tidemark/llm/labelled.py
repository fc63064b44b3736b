"""Invented documents with a known kind, to learn the quality rules from.

Every text is made of words from random syllables and of the common words of
five languages, laid out as prose, a list, a table or junk.
"""

from __future__ import annotations

import base64
import random
import string
from collections.abc import Callable

# Frequent function words of English, German, French, Spanish and Italian.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not at are this have from or an which we our its has been than their when there all so if but more into per",
    "de": "der die das und ist von für mit den dem des ein eine nicht auch auf im zu als bei wir sich aus nach unserer wird um oder noch weil auch wenn da obwohl damit",
    "fr": "le la les et de des du que qui pour dans sur est une un par plus ne pas au ce selon nous il se ont car même si à en l d puisque parce avec",
    "es": "el los las y en por con se su al lo es una para como del que pero sin sobre ha un muy hay a nuestro aunque ya mientras porque también no",
    "it": "il di che e i per con non si della in alla sono è ma gli dei una un nel sia dato anche più ha al da perché molti ci",
}
COMMON_WORDS = sorted({w for ws in COMMON.values() for w in ws.split()})
KINDS = ("prose", "list", "table", "junk")


class Writer:
    """Random documents of each kind from one seed."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.content = {lang: [self.word(self.r.choice([1, 2, 2, 3, 3, 4, 5] if lang == "de" else [1, 1, 2, 2, 3, 3, 4])) for _ in range(220)] for lang in COMMON}

    def word(self, n: int | None = None) -> str:
        n = n or self.r.choice([1, 2, 2, 3, 3])
        return "".join(self.r.choice(["b", "c", "d", "f", "g", "l", "m", "n", "p", "r", "s", "t", "v", "st", "pr"]) + self.r.choice(["a", "e", "i", "o", "u", "er", "on", "al", "in"]) for _ in range(n))

    def number(self) -> str:
        r = self.r
        return r.choice([f"{r.random() * 500:.2f}", f"{r.random() * 60:.1f}%", f"({r.random() * 60:.1f})", str(r.randrange(5, 99999)), "n/a", f"{r.randrange(1, 99999):,}", "-"])

    def date(self) -> str:
        return f"20{self.r.randrange(10, 26)}-{self.r.randrange(1, 13):02}-{self.r.randrange(1, 29):02}"

    def sentence(self, lang: str, end: bool = True, known: int = 220) -> str:
        r, out = self.r, []
        common = COMMON[lang].split()
        for _ in range(r.randrange(9, 26)):
            x = r.random()
            if x < 0.36:
                out.append(r.choice(common))
            elif x < 0.41:
                out.append(r.choice(["$", ""]) + f"{r.random() * 900:.1f}")
            else:
                out.append(r.choice(self.content[lang][:known]))
            if lang in ("fr", "it") and r.random() < 0.06:
                out[-1] = r.choice(["l'", "d'", "dell'"]) + r.choice(self.content[lang][:known])
            if r.random() < 0.07:
                out[-1] += ","
        s = " ".join(out).rstrip(",")
        return s[0].upper() + s[1:] + (r.choice([".", ".", ".", ".", "!", "?"]) if end else "")

    def item(self) -> str:
        r = self.r
        if r.random() < 0.2:
            return "".join(r.choice(string.ascii_uppercase) for _ in range(4))
        words = [self.word(r.choice([1, 2, 2, 3, 3, 4, 5])) for _ in range(r.randrange(1, 4))]
        if r.random() < 0.2:
            words.insert(0, r.choice(["the", "better than", "la", "der"]))
        s = " ".join(words)
        s = s.title() if r.random() < 0.25 else s.capitalize() if r.random() < 0.4 else s
        return s + (r.choice([f" ({r.randrange(5, 99)})", f", p. {r.randrange(2, 300)}", f" - 20{r.randrange(10, 26)}"]) if r.random() < 0.15 else "")

    def heading(self) -> str:
        return self.r.choice(["", "", " ".join(self.word(2).title() for _ in range(self.r.randrange(1, 5))), f"{self.word(2).title()} {self.date()}", f"{self.word(2)} {self.word()}:"])

    def prose(self) -> str:
        r = self.r
        lang = r.choice(["en", "en", "en", *COMMON])
        many = r.choice([1, 1, 2, 3, 4, 6, 8, 12, 60])
        known = r.choice([20, 40, 90, 220])
        layout = r.randrange(10)
        sentences = [self.sentence(lang, layout != 7, known) for _ in range(many)]
        if layout == 0:
            text = " ".join(sentences)
            width = r.randrange(45, 80)
            lines, line = [], ""
            for w in text.split():
                if len(line) + len(w) >= width:
                    lines.append(line)
                    line = w
                else:
                    line = f"{line} {w}".strip()
            text = "\n".join([*lines, line])
        elif layout == 1:
            text = "\n\n".join(f"{r.choice('QA')}: {s}" for s in sentences)
        elif layout == 2:
            text = "\n\n".join(f"{self.heading() or 'Notes'}\n{s} {self.sentence(lang)}" for s in sentences)
        elif layout == 3:
            text = " ".join(sentences).upper()
        elif layout == 4:
            text = " ".join(s + r.choice([" 🚀", "!!", " 📉", ""]) for s in sentences)
        elif layout == 5:
            text = " ".join(sentences)
            if r.random() < 0.4:
                text = "     ".join(" ".join(w) for w in text.split())
            else:
                text = text.replace(" ", "  ", many * 2)
        elif layout in (6, 7):
            text = "\n".join(s.lower() if layout == 7 else s for s in sentences)
        elif layout == 8:
            text = "\n".join(f"{r.choice(['- ', '* ', f'{i + 1}. ', '> '])}{s} {self.sentence(lang)}" for i, s in enumerate(sentences))
        else:
            text = f"{self.heading()}\n" + " ".join(sentences)
        # a short list or table inside
        if many >= 6 and r.random() < 0.35:
            part = self.listing(r.randrange(2, 5)) if r.random() < 0.5 else self.table(r.randrange(2, 4))
            text = f"{text}\n\n{part}\n\n{' '.join(self.sentence(lang) for _ in range(6))}"
        return text

    def listing(self, n: int | None = None) -> str:
        r = self.r
        n = n or r.choice([4, 5, 8, 12, 20, 30])
        items = [self.item() for _ in range(n)]
        if r.random() < 0.3:
            items = [r.choice(items[: max(2, n // 2)]) for _ in items]
        if r.random() < 0.4:
            items = ["".join(r.choice(string.ascii_uppercase) for _ in range(4)) for _ in items]
        elif r.random() < 0.3:
            items = [x.split(" (")[0] + r.choice([f" ({r.randrange(5, 99)})", f", p. {r.randrange(2, 300)}", f" - 20{r.randrange(10, 26)}"]) for x in items]
        end = r.choice(["", "", "", ";", ",", ".", "?"])
        style = r.randrange(8)
        if style == 0:
            body = (r.choice(["", ".", "?"]) + r.choice([", ", "; ", " | ", " • ", " / "])).join(items)
        elif style == 1:
            body = "\n".join(x + end for x in items)
        elif style == 2:
            body = "\n".join(f"{i + 1}{r.choice(['.', ')'])} {x}{end}" for i, x in enumerate(items))
        elif style == 3:
            body = "\n".join(f"({string.ascii_lowercase[i % 26]}) {x}{end}" for i, x in enumerate(items))
        else:
            mark = r.choice(["-", "*", "•", "+", "–", "[ ]", "[x]", "→"])
            body = "\n".join(f"{r.choice(['', '', '  '])}{mark} {x}{end}" for x in items)
        return f"{self.heading()}\n{body}".strip()

    def table(self, n: int | None = None) -> str:
        r = self.r
        n, cols = n or r.choice([3, 5, 9, 16, 30]), r.choice([2, 3, 4, 6])
        first = lambda i: r.choice([f"Q{i % 4 + 1} 20{10 + i % 16}", self.date(), self.item()])
        rows = [[self.word(2).title() for _ in range(cols)], *[[first(i), *[self.number() for _ in range(cols - 1)]] for i in range(n)]]
        style = r.randrange(8)
        if style in (0, 1):
            lines = ["| " + " | ".join(row) + " |" for row in rows]
            if style == 0:
                lines.insert(1, "|" + "---|" * cols)
        elif style == 2:
            lines = ["\t".join(row) for row in rows]
        elif style == 3:
            lines = [row[0].ljust(24) + "".join(c.rjust(12) for c in row[1:]) for row in rows]
        elif style == 4:
            lines = [",".join(c.replace(",", "") for c in row) for row in rows]
        elif style == 5:
            lines = [";".join(f'"{c}"' for c in row) for row in rows]
        elif style == 6:
            lines = [f"{row[0]} {'.' * max(5, 40 - len(row[0]))} {row[1]}" for row in rows]
        else:
            lines = ["+" + "-" * 14 * cols + "+", *["|" + "".join(c.center(14) for c in row) + "|" for row in rows], "+" + "-" * 14 * cols + "+"]
        return "\n".join([*([self.heading()] if r.random() < 0.5 else []), *lines]).strip()

    def junk(self) -> str:
        r = self.r
        n = r.choice([20, 40, 60, 120, 300, 800])
        style = r.choice([0, 1, 1, 2, 2, 3, 4, 4, 5, 6, 7, 8, 8, 9, 10])
        if style == 0:
            return " ".join(f"{r.randrange(256):02x}" for _ in range(n))
        if style == 1:
            s = base64.b64encode(r.randbytes(n * 2)).decode()
            return "\n".join(s[i : i + 76] for i in range(0, len(s), 76)) if r.random() < 0.6 else s
        if style == 2:
            return "".join(r.choice(string.printable[:94] + "   ") for _ in range(n * 2))
        if style == 3:
            signs = "←→↑↓◆◇█▒▓§¶†‡¬¤|\\/<>[]{}@%& "
            return "".join(r.choice(signs) for _ in range(n))
        if style == 4:
            return " ".join(self.word(r.choice([1, 1, 2, 2, 3, 3, 4])) for _ in range(max(10, n // 3)))
        if style == 5:
            keys = ["asdf", "jkl;", "qwer", "uiop", "zxcv", "hjkl", "ghgh", "lkj"]
            return "".join(r.choice(keys) + (" " if r.random() < 0.3 else "") for _ in range(n // 3 + 5))
        if style == 6:
            ui = ["Home", "Menu", "Login", "Share", "Cookies", "Accept all", "Back to top", "Next", "Search", "Privacy", "Follow us", "Help", "Terms", "Sign up", "Contact", "Read more"]
            return r.choice([" ", " ", " ", " | "]).join(r.choice(ui) for _ in range(max(12, n // 5)))
        if style == 7:
            phrase = r.choice([self.item(), self.sentence("en"), self.word() + " ", r.choice("#~.=*-_aX")])
            return r.choice(["", " ", "\n"]).join([phrase] * max(8, n // 3))
        if style == 8:
            return " ".join(self.sentence(r.choice(list(COMMON))) for _ in range(r.choice([1, 2, 4, 8])))[::-1]
        text = " ".join(self.sentence(r.choice(["fr", "es", "de", "it", "en"])) for _ in range(r.choice([2, 4, 8])))
        if style == 9:
            return "".join(r.choice(["Ã©", "\ufffd", "Ã\x83", "Â¿", "ï¿½"]) if r.random() < 0.3 else c for c in text)
        letters = list(text.replace(" ", ""))
        r.shuffle(letters)
        return "".join(c + (" " if r.random() < 0.15 else "") for c in letters)

    def document(self, kind: str) -> str:
        make: dict[str, Callable[[], str]] = {"prose": self.prose, "list": self.listing, "table": self.table, "junk": self.junk}
        return make[kind]()


def labelled_documents(n: int = 6000, seed: int = 11) -> list[tuple[str, str]]:
    """(kind, text) of n invented documents; a third of them prose, since that is what must be kept."""
    w = Writer(seed)
    return [(k, w.document(k)) for k in (w.r.choice(["prose", "prose", *KINDS[1:]]) for _ in range(n))]
