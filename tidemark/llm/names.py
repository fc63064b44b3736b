"""Variant spellings of names typed by people, linked by a noisy channel.

A typed name is what an entity's canonical form became on its way through
abbreviation, reordering, nicknames, initials and typing errors. Frequent
spellings are the candidate forms. Each spelling is attached to the candidate
with the greatest posterior: the form's frequency times the channel's
likelihood of the typed one, against that of being a name of its own.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.session import cut_lineage

# Words of organisations' names and how they are shortened.
DESIGNATORS = {
    "securities": "sec secs security", "advisory": "adv advsy advis", "services": "serv servs svc svcs service", "equity": "eq eqty equities",
    "research": "rsch res resch", "capital": "cap", "markets": "mkt mkts market", "financial": "fin finl fncl finance", "group": "gp grp", "trust": "tr trst",
    "investment": "inv invt invst invs invts investments", "investors": "", "asset": "ast assets", "management": "mgt mgmt mngt", "partners": "ptnrs ptrs ptr prtnrs partner",
    "brothers": "bros", "company": "co", "international": "intl int", "bank": "bk bnk banking", "holdings": "hldgs hldg holding", "associates": "assoc assocs", "global": "glbl",
    "fund": "fd funds", "foundation": "fdn fndn", "insurance": "ins", "bancorp": "", "ventures": "vent venture", "wealth": "", "brokers": "brk", "brokerage": "",
    "analytics": "", "strategies": "strat", "estate": "est", "family": "fam", "institute": "inst", "corporation": "corp",
}
# Parts that say nothing about who is named.
IGNORED = set("the and of mr mrs ms miss dr prof hon sir md phd esq cpa llc llp lp ltd plc inc us usa uk gmbh ag sa nv".split())
# Which of the bearers of one name is meant.
GENERATIONS = set("jr sr ii iii iv".split())
# Short forms of given names.
NICKNAMES = {
    "abigail": "abby abbie gail", "alexander": "alex al sandy alec", "alexandra": "alex sandra", "andrew": "andy drew", "anthony": "tony ant", "barbara": "barb barbie",
    "benjamin": "ben benny", "catherine": "cathy cate", "charles": "charlie chuck chas", "christine": "chris tina", "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave davy",
    "deborah": "deb debbie", "donald": "don donnie", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty eliza lizzie bess", "eugene": "gene", "frances": "fran", "frederick": "fred freddie freddy",
    "gerald": "gerry jerry", "gregory": "greg", "harold": "hal harry", "henry": "hank", "jacob": "jake", "james": "jim jimmy jamie", "jeffrey": "jeff", "jennifer": "jen jenny jenn",
    "jessica": "jess", "john": "jack johnny", "jonathan": "jon", "joseph": "joe joey", "joshua": "josh", "judith": "judy", "katherine": "kate kathy kat katie kathryn", "kenneth": "ken kenny",
    "lawrence": "larry", "leonard": "len lenny", "margaret": "maggie peggy meg marge", "matthew": "matt", "michael": "mike mick mikey", "nathaniel": "nate nat", "nicholas": "nick nicky", "pamela": "pam",
    "patricia": "pat trish patty tricia", "patrick": "paddy", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert",
    "ronald": "ron", "samantha": "sam", "samuel": "sam sammy", "stephen": "steve", "steven": "steve", "susan": "sue susie suzy", "theodore": "ted teddy theo", "thomas": "tom tommy", "timothy": "tim",
    "victoria": "vicky tori vicki", "vincent": "vince", "walter": "walt", "william": "bill will billy willy liam", "zachary": "zach",
}
SHORT_WORD = {s: w for w, shorts in DESIGNATORS.items() for s in [w, *shorts.split()]}
FULL_NAMES: dict[str, set[str]] = {}
for _full, _shorts in NICKNAMES.items():
    for _s in _shorts.split():
        FULL_NAMES.setdefault(_s, set()).add(_full)
# The rows of a keyboard.
KEYS = {c: (x + 0.3 * y, y) for y, row in enumerate(("qwertyuiop", "asdfghjkl", "zxcvbnm")) for x, c in enumerate(row)}
# Log likelihoods of the channel's steps.
TYPO, RARE_TYPO, DROPPED, INITIAL, NICK, ACRONYM, SHORTENED = -3.2, -7.5, -2.0, -1.6, -1.2, -5.0, -0.7
#: what a spelling loses as a name of its own beside a form it can be typed from, and the most a token's errors may cost
OWN, TOKEN_LIMIT, LIMIT = -11.0, -6.5, -10.0
#: what a spelling may lose against a rarer form: a slip may be more frequent than what it is a slip of
RARER_LIMIT = -5.6


def near_keys(a: str, b: str) -> bool:
    return a in KEYS and b in KEYS and abs(KEYS[a][0] - KEYS[b][0]) <= 1.35 and abs(KEYS[a][1] - KEYS[b][1]) <= 1


def fold(text: str) -> str:
    """Without accents: two spellings that differ by them alone are one."""
    text = text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("æ", "ae").replace("ł", "l").replace("Ł", "L")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@lru_cache(maxsize=100_000)
def typing(typed: str, meant: str) -> float:
    """Log likelihood of typing one word for another: slips of a neighbouring key, doubled, left out and swapped letters."""
    if typed == meant:
        return 0.0
    n, m = len(typed), len(meant)
    if abs(n - m) > 2 or min(n, m) < 3:
        return -math.inf
    cost = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if not i and not j:
                continue
            best = math.inf
            if i and j:
                same = typed[i - 1] == meant[j - 1]
                best = cost[i - 1][j - 1] + (0.0 if same else -TYPO if near_keys(typed[i - 1], meant[j - 1]) else -RARE_TYPO)
            if j:
                best = min(best, cost[i][j - 1] - TYPO)
            if i:
                c = typed[i - 1]
                beside = (i > 1 and (typed[i - 2] == c or near_keys(typed[i - 2], c))) or (i < n and (typed[i] == c or near_keys(typed[i], c)))
                best = min(best, cost[i - 1][j] + (-TYPO if beside else -RARE_TYPO * 0.85))
            if i > 1 and j > 1 and typed[i - 1] == meant[j - 2] and typed[i - 2] == meant[j - 1] and typed[i - 1] != typed[i - 2]:
                best = min(best, cost[i - 2][j - 2] - TYPO)
            cost[i][j] = best
    return -cost[n][m]


#: designators long enough to be read through slips, and how much these may cost
SLIPPED = {d: 2 * TYPO if len(d) >= 6 else TYPO for d in SHORT_WORD if len(d) >= 5 or d in ("bank", "fund")}


@lru_cache(maxsize=50_000)
def designator(word: str) -> str | None:
    """The designator a word is, is short for, or is a slip of."""
    if word in SHORT_WORD:
        return SHORT_WORD[word]
    if len(word) >= 4:
        near = [d for d in SLIPPED if word[0] in d[:2] and abs(len(d) - len(word)) <= 2]
        close = sorted((-typing(word, d), SHORT_WORD[d]) for d in near if typing(word, d) >= SLIPPED[d])
        if close:
            return close[0][1]
    return None


def unhyphened(part: str) -> list[str]:
    """A double name as one word; its parts where one of them is a designator or a single letter."""
    words = part.split("-")
    if len(words) > 1 and not any(designator(w) or w in IGNORED or (len(w) == 1 and len(words) == 2) for w in words):
        return ["".join(words)]
    return words


class Name:
    """A typed name in parts: proper words, designators, initials, the generation; or an acronym."""

    __slots__ = ("acronym", "generation", "initials", "proper", "titles")

    def __init__(self, text: str) -> None:
        plain = fold(text)
        letters = re.sub(r"[^A-Za-z]", "", plain)
        self.acronym = letters.lower() if 2 <= len(letters) <= 6 and re.fullmatch(r"\s*(?:[A-Z]\.?\s?){2,6}\s*", plain) else ""
        plain = re.sub(r"(?<=[a-z]{2})(?=[A-Z][a-z])", " ", plain)
        plain = re.sub(r"\b(?:L\.L\.C|L\.P|P\.L\.C|S\.A|N\.V)\.?\s*$", " ", plain, flags=re.IGNORECASE)
        words = [w for part in re.findall(r"[a-z0-9]+(?:-[a-z0-9]+)*", re.sub(r"['’]", "", plain.lower())) for w in unhyphened(part)]
        self.generation = next((w for w in words[1:] if w in GENERATIONS), "")
        words = [w for w in words if w not in IGNORED and w not in GENERATIONS]
        found = [(w, designator(w)) for w in words]
        # a person's name has no designator but by accident of a single letter
        self.titles = tuple(sorted(d for _, d in found if d)) if any(d and len(w) > 1 for w, d in found) else ()
        rest = [w for w, d in found if not (d and len(w) > 1)]
        self.proper = tuple(sorted(w for w in rest if len(w) > 1))
        self.initials = tuple(sorted(w for w in rest if len(w) == 1))

    def skeleton(self) -> str:
        if self.acronym:
            return "#" + self.acronym
        proper = sorted(min(FULL_NAMES[w]) if not self.titles and w in FULL_NAMES and len(FULL_NAMES[w]) == 1 else w for w in self.proper)
        return " ".join(proper) + "|" + " ".join(self.titles) + "|" + " ".join(self.initials)


@lru_cache(maxsize=100_000)
def parsed(text: str) -> Name:
    return Name(text)


@lru_cache(maxsize=200_000)
def word_given(typed: str, meant: str, person: bool) -> float:
    """Log likelihood of one proper word for another."""
    best = typing(typed, meant)
    if person and best < 0:
        a, b = FULL_NAMES.get(typed, set()), FULL_NAMES.get(meant, set())
        if meant in a or typed in b or a & b:
            best = max(best, NICK)
        else:
            best = max([best, *(NICK + typing(full, meant) for full in a), *(NICK + typing(typed, full) for full in b)])
    return best if best >= (RARE_TYPO if min(len(typed), len(meant)) >= 6 else TOKEN_LIMIT) else -math.inf


def channel(typed: Name, meant: Name) -> float:
    """Log likelihood of the typed name given the form that was meant."""
    if typed.acronym or meant.acronym:
        if typed.acronym and meant.acronym:
            return 0.0 if typed.acronym == meant.acronym else -math.inf
        return -math.inf
    if bool(typed.titles) != bool(meant.titles) and (typed.initials or meant.initials):
        return -math.inf
    if typed.generation and meant.generation and typed.generation != meant.generation:
        return -math.inf
    person = not typed.titles and not meant.titles
    score = 0.0
    if typed.titles != meant.titles:
        fewer, more = sorted((list(typed.titles), list(meant.titles)), key=len)
        left = list(more)
        for t in fewer:
            if t not in left:
                return -math.inf
            left.remove(t)
        score += DROPPED * len(left) ** 0.5
    a, b, joins = rejoined(list(typed.proper), list(meant.proper))
    if not a or not b:
        return -math.inf
    if "".join(a) == "".join(b):
        return score + (SHORTENED if a != b or joins else 0.0) + _initials(typed, meant, [], [])
    best = -math.inf
    for total, typed_lacks, meant_lacks in pairings(a, b, person):
        if typed_lacks or meant_lacks:
            # a word the other one lacks may be there as an initial
            left = list(typed.initials if typed_lacks else meant.initials)
            for w in typed_lacks or meant_lacks:
                hit = next((i for i in left if i in first_letters(w)), None)
                if hit is None or not person:
                    break
                left.remove(hit)
                total += INITIAL
            else:
                best = max(best, total + _initials(typed, meant, typed_lacks, meant_lacks))
        else:
            best = max(best, total + _initials(typed, meant, [], []))
    return score + best + SHORTENED * joins


def first_letters(word: str) -> set[str]:
    return {w[0] for w in (word, *FULL_NAMES.get(word, ()))}


def rejoined(a: list[str], b: list[str]) -> tuple[list[str], list[str], int]:
    """Both names' words, those of the one joined that stand as one word in the other, and how many were."""
    if sorted(a) == sorted(b) or len(a) == len(b):
        return a, b, 0
    long, short = (list(a), b) if len(a) > len(b) else (list(b), a)
    joins = 0
    for whole in short:
        if whole in long:
            continue
        hit = next((p for n in (2, 3) for p in permutations(range(len(long)), n) if "".join(long[i] for i in p) == whole), None)
        if hit:
            long = [w for i, w in enumerate(long) if i not in hit] + [whole]
            joins += 1
    long.sort()
    return (long, b, joins) if len(a) > len(b) else (a, long, joins)


def pairings(a: list[str], b: list[str], person: bool) -> Iterator[tuple[float, list[str], list[str]]]:
    """Each way to read the words of the shorter name as words of the other: (log likelihood, words a lacks, words b lacks)."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    ways = []
    for x in short:
        found = [(word_given(x, y, person) if short is a else word_given(y, x, person), k) for k, y in enumerate(long)]
        ways.append(sorted(((v, k) for v, k in found if v >= LIMIT), reverse=True))
    ways.sort(key=len)

    def walk(at: int, total: float, taken: frozenset[int]) -> Iterator[tuple[float, list[str], list[str]]]:
        if at == len(ways):
            spare = [y for k, y in enumerate(long) if k not in taken]
            yield (total, spare, []) if short is a else (total, [], spare)
            return
        for v, k in ways[at]:
            if k not in taken and total + v >= LIMIT:
                yield from walk(at + 1, total + v, taken | {k})

    return walk(0, 0.0, frozenset())


def _initials(typed: Name, meant: Name, typed_lacks: list[str], meant_lacks: list[str]) -> float:
    """A middle initial may be left out, not changed."""
    a, b = list(typed.initials), list(meant.initials)
    for lacks, mine in ((typed_lacks, a), (meant_lacks, b)):
        for w in lacks:
            hit = next((i for i in mine if i in first_letters(w)), None)
            if hit is not None:
                mine.remove(hit)
    if a and b and not set(a) & set(b):
        return -math.inf
    return SHORTENED * abs(len(a) - len(b))


def acronyms(name: Name) -> set[str]:
    """What the name's words can be shortened to; the order of words is lost, so letters are sorted."""
    if name.acronym or name.initials or not name.proper or len(name.proper) + len(name.titles) < 2:
        return set()
    return {"".join(sorted(w[0] for w in (*name.proper, *name.titles)))}


def without_letters(word: str, n: int) -> set[str]:
    """The word with up to n letters left out."""
    return {"".join(c for i, c in enumerate(word) if i not in gone) for k in range(n + 1) for gone in combinations(range(len(word)), k)}


def block_keys(name: Name) -> list[tuple[str, str]]:
    """(key, word) of which a spelling shares a key with any form it can be typed from.

    A proper word, with one letter left out too, beside the first letter of
    another proper word, or of an initial if there is none: of two names every
    word is read in the other, so one key holds unless a word has two slips and
    another one a slip at its beginning. A name of one proper word has the word
    alone as well, with two letters left out if it is long. Acronyms, and all
    words as one. `word` is empty where nothing is left out: two spellings that
    have the word in common need none of its other keys.
    """
    if name.acronym:
        return [("#" + "".join(sorted(name.acronym)), "")]
    out = {("#" + a, "") for a in acronyms(name)} | {("".join(name.proper), "")}
    for at, w in enumerate(name.proper):
        alone = len(name.proper) == 1
        others = set(name.initials) if alone else {c for k, x in enumerate(name.proper) if k != at for c in first_letters(x)}
        for full in (w, *FULL_NAMES.get(w, ())):
            for k in without_letters(full, 1 if len(full) >= 4 else 0):
                out |= {(f"{k} {c}", "" if k == full else full) for c in others}
            if alone:
                out |= {(k, "" if k == full else full) for k in without_letters(full, 2 if len(full) >= 6 else 1 if len(full) >= 4 else 0)}
    return sorted(out)


def link_spellings(names: DataFrame) -> DataFrame:
    """(scope, name, entity): every distinct spelling with the class of its entity.

    names: (scope STRING, name STRING), one row for each time a name was typed.
    Spellings are only linked within a scope. Spellings that agree after case,
    punctuation, order, titles, legal forms, known abbreviations and nicknames
    form one skeleton, unless bearers of two generations (Jr, Sr, II ...) share
    it: then each is one of its own, and the plain name goes with the most
    frequent. A skeleton is attached to the one with the greatest posterior among
    the more frequent ones it shares a key with; one without any, to the best of
    the rarer ones that it is plainly a slip of, for a slip may be more frequent
    than what was meant. NULL scopes and NULL or wordless names are left out;
    repeated rows raise a spelling's frequency.
    """
    typed = names.where("scope is not null and name is not null").groupBy("scope", "name").agg(F.count("*").alias("n"))

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["plain"] = [parsed(t).skeleton() for t in f["name"]]
            f["generation"] = [parsed(t).generation or None for t in f["name"]]
            yield f[f["plain"] != "||"]

    parallel = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    typed = typed.repartition(parallel, "name").mapInPandas(split, "scope string, name string, n long, plain string, generation string")
    same = Window.partitionBy("scope", "plain")
    several = F.min("generation").over(same) < F.max("generation").over(same)
    typed = typed.withColumn("bearers", F.sum("n").over(Window.partitionBy("scope", "plain", "generation")))
    own = F.coalesce("generation", F.max_by("generation", F.when(F.col("generation").isNotNull(), F.struct("bearers", "generation"))).over(same))
    typed = typed.withColumn("skeleton", F.when(several, F.concat_ws("|", "plain", own)).otherwise(F.col("plain")))
    typed = cut_lineage(typed.select("scope", "name", "n", "skeleton"), "typed")
    forms = typed.groupBy("scope", "skeleton").agg(F.sum("n").alias("n"), F.max_by("name", F.struct("n", "name")).alias("name"))
    forms = cut_lineage(forms.repartition(parallel, "skeleton").withColumn("id", F.monotonically_increasing_id()), "forms")

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(i, scope, k, w) for i, scope, t in zip(f["id"], f["scope"], f["name"], strict=True) for k, w in block_keys(parsed(t))]
            yield pd.DataFrame(rows, columns=["id", "scope", "key", "word"])

    keys = forms.select("id", "scope", "name").mapInPandas(keyed, "id long, scope string, key string, word string")
    # two keys with one hash only make a candidate more
    keys = keys.select("id", F.xxhash64("scope", "key").alias("key"), F.when(F.col("word") != "", F.xxhash64("word")).alias("word"), F.col("key").startswith("#").alias("letters"))
    keys = cut_lineage(keys, "keys")
    a = keys.select("key", F.col("id").alias("a"), F.col("word").alias("wa"), "letters")
    b = keys.select("key", F.col("id").alias("b"), F.col("word").alias("wb"))
    pairs = a.join(b, "key").where("a <> b and (wa is null and wb is null or not wa <=> wb)").select("a", "b", "letters").distinct()
    side = lambda x: forms.select(F.col("id").alias(x), "scope", F.col("skeleton").alias(f"s{x}"), F.col("n").alias(f"n{x}"), F.col("name").alias(f"t{x}"))
    # an acronym hangs on a full form, however rare
    rank = lambda s, n: F.struct((~F.col(s).startswith("#")).alias("f"), F.col(n).alias("n"), F.col(s).alias("s"))
    pairs = pairs.join(side("a"), "a").join(side("b").withColumnRenamed("scope", "scope_b"), "b").where("scope = scope_b and (not letters or sa like '#%' or sb like '#%')")
    pairs = pairs.select("scope", "sa", "ta", "na", "sb", "tb", "nb", (rank("sb", "nb") > rank("sa", "na")).alias("up"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for ta, tb, nb, up in zip(f["ta"], f["tb"], f["nb"], f["up"], strict=True):
                x, y = parsed(ta), parsed(tb)
                if up:
                    like = ACRONYM if x.acronym and not y.acronym and "".join(sorted(x.acronym)) in acronyms(y) and acronym_order(x.acronym, tb) else channel(x, y)
                    ok = like >= LIMIT
                else:
                    # initials and dropped words fit several names: against a rarer form only slips and nicknames count
                    alike = not x.acronym and not y.acronym and len(x.proper) == len(y.proper) and x.titles == y.titles
                    like = channel(x, y) if alike else -math.inf
                    ok = like >= RARER_LIMIT
                out.append(like + math.log(nb) if ok else -math.inf)
            f["posterior"] = out
            f = f[(f["posterior"] > -1e6)]
            f = f[f["posterior"] > OWN + f["na"].map(math.log)]
            yield f[["scope", "sa", "sb", "up", "posterior"]]

    scored = pairs.mapInPandas(score, "scope string, sa string, sb string, up boolean, posterior double")
    best = scored.groupBy("scope", "sa").agg(F.max_by("sb", F.struct("up", "posterior", "sb")).alias("sb"))
    node = lambda c: F.concat_ws("\u0001", "scope", c)
    links = connected_components(best.select(node("sa").alias("a"), node("sb").alias("b")))
    out = typed.withColumn("node", node("skeleton")).join(links, "node", "left")
    return out.select("scope", "name", F.sha2(F.coalesce("root", "node"), 256).alias("entity"))


def acronym_order(letters: str, text: str) -> bool:
    """Whether the words of the full form, as typed or with its designators last, begin with the letters in order."""
    plain = re.sub(r"(?<=[a-z]{2})(?=[A-Z][a-z])", " ", fold(text)).lower()
    words = [w for w in re.findall(r"[a-z0-9]+", plain) if w not in IGNORED]
    proper, titles = [w for w in words if not designator(w)], [w for w in words if designator(w)]
    return letters in ("".join(w[0] for w in words), "".join(w[0] for w in [*proper, *titles]))


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """(scope, name_a, name_b): all pairs of different spellings of an entity, name_a before name_b by code points."""
    a = linked.select("scope", "entity", F.col("name").alias("name_a"))
    b = linked.select("scope", "entity", F.col("name").alias("name_b"))
    return a.join(b, ["scope", "entity"]).where("name_a < name_b").select("scope", "name_a", "name_b")
