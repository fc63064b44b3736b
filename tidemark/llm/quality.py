"""Per-document text quality statistics, and a rule list that tells prose from lists, tables and junk.

The statistics are column expressions. The rules are induced by incremental
reduced-error pruning from labelled documents and applied as one CASE.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.labelled import COMMON_WORDS, labelled_documents

BULLET = r"^\s*(?:[-*•+–—→>]|\[[ xX]?\]|\(?[0-9]{1,3}[.)]|\(?[a-zA-Z][.)])\s+"
# what fields are set apart by: signs found as they are, two blanks, and a comma or semicolon without a blank that isn't a number's
FIELD_SIGNS = ("|", "\t", "....", '";"')
FIELD_COMMA = r"[;,](?:[^\s\d]|(?<=[^\d\s].)\d)"
# whole words; possessive, so that a word of any length takes linear time
LETTERS = r"[(\"'“«¿¡]*+\p{L}[\p{L}'’&-]*+[.,;:!?)\"'”»…]*+"
NUMBER = r"[(\[$€£+\-\"]*+\p{N}[\p{N}.,:/\-]*+[%)\]\".,;:?]*+"
MARK = r"[^\p{L}\p{N}\s]{1,3}|[-=_.*+|]{4,}+|[A-Z]{1,3}[$€£¥]|&(?:[a-zA-Z]+|#[0-9]+);"
STATISTICS = (
    "n_words", "n_lines", "mean_word_length", "symbol_ratio", "digit_ratio", "end_punctuation_share", "common_word_share", "words_per_line",
    "bullet_line_share", "field_line_share", "numeric_word_share", "separator_density", "letter_word_share", "damage_ratio",
    "words_per_sentence", "longest_word", "odd_word_share", "distinct_word_rate", "distinct_line_share",
)


def statistics(df: DataFrame, text: str = "text", wanted: Sequence[str] = STATISTICS) -> DataFrame:
    """`df` with a struct column `stats` of the wanted statistics for each whole text; NULL for null, empty and blank texts.

    Lines are the non-blank ones; words are runs of non-space characters.
    distinct_word_rate is distinct words over the square root of words, which
    hardly depends on length. Repeated rows each come out.
    """
    t = F.col(text)
    plain = F.regexp_replace(t, r"\r\n|[\r\u0085\u2028\u2029\u000B\u000C]", "\n")
    plain = F.regexp_replace(plain, r"[\u00A0\u2007\u202F\u3000]", " ")
    plain = F.regexp_replace(plain, r"[\u200B-\u200D\uFEFF\u00AD]", "")
    rare = t.rlike(r"[\r\u0085\u2028\u2029\u000B\u000C\u00A0\u2007\u202F\u3000\u200B-\u200D\uFEFF\u00AD]")
    df, t = df.withColumn("__t0", F.when(rare, plain).otherwise(t)), F.col("__t0")
    # letter-spaced text: single letters one blank apart, words several
    spaced = t.contains("  ") & t.rlike(r"\S {2,9}\S") & (F.length(F.regexp_replace(t, r"\S(?= {1,9}\S\b)", "")) < F.length(t) * 0.62)
    df = df.withColumn("__t", F.when(spaced, F.regexp_replace(t, r"(?<=\S) (?=\S)", "")).otherwise(t)).drop("__t0")
    df = df.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.trim(F.translate(x, "\t", " ")) != ""))
    df = df.withColumn("__w", F.filter(F.split("__t", r"\s+"), lambda x: x != ""))
    # words of letters only, in lower case: one pass over the text, not one over each word
    df = df.withColumn("__b", F.split(F.regexp_replace(F.lower("__t"), r"[^\p{L}\s]++", ""), r"\s+"))
    # what is neither letter nor space
    df = df.withColumn("__s", F.regexp_replace("__t", r"[\p{L}\s]++", ""))
    d = lambda c: c.cast("double")
    count = lambda pattern, of="__t": d(F.regexp_count(of, F.lit(pattern)))
    words, lines = d(F.size("__w")), d(F.size("__l"))
    chars = d(F.length(F.array_join("__w", "")))
    digits = count(r"\p{N}", "__s")
    share = lambda array, test: d(F.size(F.filter(array, test)))
    whole = lambda pattern: count(rf"(?<!\S)(?:{pattern})(?!\S)")

    def fields(x: Column) -> Column:
        found = x.rlike(FIELD_COMMA) | (x.contains("  ") & x.rlike(r"\S {2,}\S"))
        for sign in FIELD_SIGNS:
            found = x.contains(sign) | found
        return found

    stats = {
        "n_words": words,
        "n_lines": lines,
        "mean_word_length": chars / words,
        "symbol_ratio": (d(F.length("__s")) - digits) / chars,
        "digit_ratio": digits / chars,
        "end_punctuation_share": share("__l", lambda x: x.rlike(r"[.!?…][\"'”’»)\]]*\s*$")) / lines,
        "common_word_share": share("__b", lambda x: x.isin(COMMON_WORDS)) / words,
        "words_per_line": words / lines,
        "bullet_line_share": share("__l", lambda x: x.rlike(BULLET)) / lines,
        "field_line_share": share("__l", fields) / lines,
        # from its first digit to its end each such word is one match
        "numeric_word_share": count(r"\p{N}\S*+") / words,
        "separator_density": count(r"[,;|•/](?=\s)") / words,
        "letter_word_share": whole(LETTERS) / words,
        "damage_ratio": count(r"[\uFFFDÃÂ\u0080-\u009F←-⇿▀-◿¤¬§¶†‡]|ï¿½") / chars,
        "words_per_sentence": words / (F.lit(1.0) + count(r"[.!?…][\"'”’»)]*(?=\s|$)")),
        "longest_word": d(F.array_max(F.transform("__w", lambda x: F.length(x)))),
        # neither letters, nor a number, nor a mark of layout: of the three a word is one at most
        "odd_word_share": (words - whole(f"{LETTERS}|{NUMBER}|{MARK}")) / words,
        "distinct_word_rate": d(F.size(F.array_distinct("__b"))) / F.sqrt(words),
        "distinct_line_share": d(F.size(F.array_distinct("__l"))) / lines,
    }
    struct = F.when(F.size("__w") > 0, F.struct(*[stats[s].alias(s) for s in wanted]))
    # a generated row of one: the optimizer can't copy the statistics into each rule that reads one
    return df.withColumn("stats", F.explode(F.array(struct))).drop("__t", "__l", "__w", "__b", "__s")


Condition = tuple[int, bool, float]  # feature, at least (else below), threshold


def _covers(x: np.ndarray, rule: Sequence[Condition]) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for f, least, v in rule:
        ok &= (x[:, f] >= v) if least else (x[:, f] < v)
    return ok


def _grow(x: np.ndarray, y: np.ndarray) -> list[Condition]:
    """Conditions added by the greatest gain of information until no negative is covered."""
    rule: list[Condition] = []
    live = np.ones(len(x), bool)
    while (~y[live]).any() and len(rule) < 6:
        p0, n0 = y[live].sum(), (~y[live]).sum()
        base = np.log2(p0 / (p0 + n0))
        best = (1e-9, None)
        for f in range(x.shape[1]):
            order = np.argsort(x[live, f], kind="stable")
            v, lab = x[live, f][order], y[live][order]
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(cut):
                continue
            below = np.cumsum(lab)[cut - 1]
            for least, p, total in ((False, below, cut), (True, p0 - below, len(v) - cut)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / total) - base), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, least, float((v[cut[k]] + v[cut[k] - 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        live = _covers(x, rule)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, y: np.ndarray) -> tuple[list[Condition], float]:
    """The prefix of the rule that does best on the pruning set, and its precision there."""

    def worth(r: Sequence[Condition]) -> float:
        c = _covers(x, r)
        p, n = (y & c).sum(), (~y & c).sum()
        return (p - n) / max(1, p + n)

    best = max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k]), -k))
    c = _covers(x, rule[:best])
    return rule[:best], float((y & c).sum() / max(1, c.sum()))


def induce(x: np.ndarray, kinds: Sequence[str], order: Sequence[str] = ("table", "list", "junk"), seed: int = 3, least_precision: float = 0.9, tries: int = 6) -> list[tuple[str, list[Condition]]]:
    """An ordered rule list: for each kind rules are grown, pruned on held-out documents and kept while they are precise; a kind is done when `tries` of its rules weren't."""
    y_all = np.asarray(kinds)
    rng = np.random.default_rng(seed)
    rules: list[tuple[str, list[Condition]]] = []
    live = np.ones(len(x), bool)
    for kind in order:
        failed = 0
        while failed < tries and (y_all[live] == kind).any():
            at = rng.permutation(np.flatnonzero(live))
            cut = len(at) * 2 // 3
            grow, prune = at[:cut], at[cut:]
            rule = _grow(x[grow], y_all[grow] == kind) if (y_all[grow] == kind).any() else []
            precision = 0.0
            if rule:
                rule, precision = _prune(rule, x[prune], y_all[prune] == kind)
            if precision < least_precision:
                failed += 1
                continue
            rules.append((kind, rule))
            live &= ~_covers(x, rule)
    return rules


def rules_to_case(rules: Sequence[tuple[str, Sequence[Condition]]], prefix: str = "stats.") -> str:
    """The rule list as one SQL CASE expression."""
    whens = [f"WHEN {' AND '.join(f'{prefix}{STATISTICS[f]} {">=" if least else "<"} {v!r}D' for f, least, v in rule)} THEN '{kind}'" for kind, rule in rules]
    return "CASE " + " ".join([f"WHEN {prefix[:-1]} IS NULL THEN NULL", *whens]) + " ELSE 'prose' END"


_LEARNED: dict[tuple, list] = {}


def learned_rules(spark: SparkSession, documents: int = 6000, seed: int = 11) -> list[tuple[str, list[Condition]]]:
    """Rules from `documents` invented, labelled documents (that is all that reaches the driver)."""
    key = (documents, seed)
    if key not in _LEARNED:
        rows = statistics(spark.createDataFrame(labelled_documents(documents, seed), "kind string, text string")).where("stats is not null").select("kind", "stats.*").collect()
        _LEARNED[key] = induce(np.array([[r[s] for s in STATISTICS] for r in rows], dtype=float), [r["kind"] for r in rows])
    return _LEARNED[key]


def document_kinds(df: DataFrame, text: str = "text", documents: int = 6000, wanted: Sequence[str] = ()) -> DataFrame:
    """`df` with `stats` (the wanted statistics and those the rules read) and `doc_kind` (prose, list, table or junk; NULL where there are no words)."""
    rules = learned_rules(df.sparkSession, documents)
    read = {STATISTICS[f] for _, rule in rules for f, _, _ in rule}
    return statistics(df, text, [s for s in STATISTICS if s in read or s in wanted]).withColumn("doc_kind", F.expr(rules_to_case(rules)))
