"""Encoding, mixing, pairs, overlaps, names and quality."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import encode, mixing, names, overlap, pairs, quality
from tidemark.llm.labelled import KINDS, labelled_documents

HAVE = Path(encode.VOCABULARY).exists()
needs_vocabulary = pytest.mark.skipif(not HAVE, reason="no vocabulary files")


@pytest.fixture(scope="module")
def plain_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encode.VOCABULARY)
    t.encode_special_tokens = True
    return t


TEXTS = ["", " ", "a" * 3000, "abab" * 700, "<|endoftext|>", "\n\n \t x  y", "émigré ß 漢字 🚀🚀", "don't I'LL we've", "x = 1,234.50%;;;", "​﻿ ", "é́́", "  lead", "0123456789" * 30, "-----====....", "zqxjkvbpygfwm" * 80]


@needs_vocabulary
@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_public_library(plain_tokenizer, text):
    assert encode.encoder().encode(text) == plain_tokenizer.encode(text, add_special_tokens=False).ids


@needs_vocabulary
@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_of_any_text(plain_tokenizer, text):
    assert encode.encoder().encode(text) == plain_tokenizer.encode(text, add_special_tokens=False).ids


@needs_vocabulary
def test_encode_column_nulls_empties_repeats(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (4, "a" * 50_000)], "doc_id long, text string")
    out = encode.encode_column(df, "doc_id", "text").collect()
    got = [(r["doc_id"], list(r["ids"])) for r in out]
    assert sorted(got)[:4] == [(1, []), (2, []), (3, [31373, 995]), (3, [31373, 995])]
    assert out[0].asDict().keys() == {"doc_id", "ids"}
    assert encode.encode_column(df.where("false"), "doc_id", "text").count() == 0


def test_mix_reaches_the_shares_and_keeps_the_caps(spark):
    r = random.Random(3)
    docs = [(i, s, r.randrange(50, 150)) for i, s in enumerate(["a"] * 900 + ["b"] * 250 + ["c"] * 60 + [None] * 5)] + [(9000, "zero", 0), (9001, "other", 99)]
    w = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 8), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    mix, shares = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, source string, n_tokens long"), w, block_tokens=512)
    got = {x["source"]: x for x in shares.collect()}
    for s, t in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(got[s]["actual_share"] - t) < 0.02
    rows = mix.collect()
    assert max(x["copy"] for x in rows if x["source"] == "a") == 1
    for s, cap in (("a", 1), ("b", 3), ("c", 8)):
        assert got[s]["most_copies"] <= cap
    assert len({(x["doc_id"], x["copy"]) for x in rows}) == len(rows)
    assert got["none"]["tokens"] == 0


def test_mix_with_texts_longer_than_blocks(spark):
    """A few very long texts in small sources don't spoil the shares; every text is used as often as its source's passes say."""
    r = random.Random(8)
    docs, i = [], 0
    for s, n in (("a", 700), ("b", 150), ("c", 90)):
        for k in range(n):
            docs.append((i, s, 6000 if k % 50 == 3 else r.randrange(5, 200)))
            i += 1
    shares = {"a": (0.62, 2), "b": (0.3, 4), "c": (0.08, 3)}
    w = spark.createDataFrame([(s, t, m) for s, (t, m) in shares.items()], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, source string, n_tokens long"), w, block_tokens=500)
    for x in report.collect():
        # two long texts are more than half of c: where one stays out, all short ones can't make up for it
        assert abs(x["actual_share"] / x["target_share"] - 1) < (0.03 if x["source"] == "c" else 0.01)
        assert x["most_copies"] <= x["max_repeats"]
    rows = mix.collect()
    assert len({(x["doc_id"], x["copy"]) for x in rows}) == len(rows)
    size = {d: n for d, _, n in docs}
    assert all(size[x["doc_id"]] == x["n_tokens"] for x in rows)
    for s in shares:
        uses = Counter(x["doc_id"] for x in rows if x["source"] == s)
        assert max(uses.values()) - min(uses.get(d, 0) for d, t, _ in docs if t == s) <= 1
    # every stretch of the mix has the shares, but for what one block and one long text change
    half = sorted(rows, key=lambda x: x["slot"])[: len(rows) // 2]
    tokens = Counter()
    for x in half:
        tokens[x["source"]] += x["n_tokens"]
    for s, (t, _) in shares.items():
        assert abs(tokens[s] / sum(tokens.values()) - t) < 0.06


def test_mix_reports_sources_that_run_out(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], 100) for i in range(40)], "doc_id long, source string, n_tokens long")
    w = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 1)], "source string, target_share double, max_repeats int")
    _, shares = mixing.mix_sources(docs, w, block_tokens=100, total_tokens=100_000)
    assert {x["source"]: x["tokens"] for x in shares.collect()} == {"a": 2000, "b": 2000}
    empty, report = mixing.mix_sources(docs.where("false"), w)
    assert empty.count() == 0
    assert [x["actual_share"] for x in report.collect()] == [0.0, 0.0]


EN = "The filing shows that costs rose by 5% in the north, and the board expects that to last. We would wait for the next report."
DE = "Der Kurs schloss bei 20 Euro und damit höher als im Vormonat. Nach unserer Einschätzung bleibt die Lage stabil."
PROMPT = "Should we hold ABCD (Acme Foods)?\n2024-01-01\nThe plant ran at 10% of capacity and the group posted weaker margins for the quarter.\nGive reasons and one action."


@pytest.mark.parametrize(
    ("answer", "kind"),
    [
        (None, "empty"), ("", "empty"), (" ​\n", "empty"), ("N/A", "empty"), ("{}", "empty"), ("...", "empty"),
        (EN, None), ("Sell. The gap closed.", None), (EN + ' The board said it "will not comment on rumours."', None), ("1) Costs rose. 2) We cannot rule out a fall.", None),
        ("I am unable to find support for a buy here, so waiting is the better choice.", None), ('The motto, "Geduld bringt Rendite", fits. ' + EN, None), ("```json\n{\"a\": [1, 2]}\n```", None),
        ("I'm sorry, but I can't help with requests about single stocks.", "refusal"), ("With regret, I must decline to make this recommendation.", "refusal"), ("Unfortunately I won't tell anyone whether to buy.", "refusal"),
        ("Non posso fornire consigli di investimento.", "refusal"), ("Leider kann ich keine Anlageempfehlung geben.", "refusal"), ("Je préfère ne pas me prononcer sur ce titre.", "refusal"), ("No puedo ofrecer asesoramiento financiero.", "refusal"),
        (PROMPT, "copied_question"), (PROMPT.upper(), "copied_question"), ("> " + PROMPT.replace("\n", " "), "copied_question"),
        (DE, "other_language"), (EN + " The company now expects", "truncated"), (EN + " The shares ...", "truncated"), (EN + " Buy (see the note.", "truncated"), ('{"action": "buy", "reason": "the', "truncated"), (EN + ' He said "we wait.', "truncated"),
    ],
)
def test_defects(answer, kind):
    assert pairs.defect(answer, PROMPT) == kind


@pytest.mark.parametrize("end", ["\n2.", "\n- ", "\n(b)", "\n<answer>Buy now.", "\n**Buy now."])
def test_open_lists_and_markup_are_truncated(end):
    assert pairs.defect(EN + end, PROMPT) == "truncated"


@pytest.mark.parametrize("end", ["\n2. Sales grew.", "\n<answer>Buy now.</answer>", "\n**Buy** now.", "\n**Buy now.**", " See <ticker> too.", "<br>Buy."])
def test_closed_lists_and_markup_are_whole(end):
    assert pairs.defect(EN + end, PROMPT) is None


def test_quotations_inches_errors_and_actions():
    quote = "We will not comment. " * 40 + "Wir können und dürfen das nicht sagen. " * 20
    assert pairs.defect(EN + f' The board said "{quote.strip()}"', PROMPT) is None
    assert pairs.defect('He said the 10" pipe rose. Buy it.', PROMPT) is None
    assert pairs.defect('He said "by 10" and left. Buy it.', PROMPT) is None
    assert pairs.defect("request timed out", PROMPT, "Request timed out") == "empty"
    assert pairs.defect("request timed out", PROMPT) == "truncated"
    assert pairs.defect("Hold", PROMPT, None, " hold ") is None
    assert pairs.defect(EN, PROMPT, "length limit reached") is None


def test_defects_without_prompt_and_column(spark):
    assert pairs.defect(DE, None) is None
    rows = [(1, PROMPT, None), (2, None, EN), (3, PROMPT, PROMPT), (3, PROMPT, PROMPT), (4, PROMPT, (EN + " ") * 400)]
    out = pairs.defective_pairs(spark.createDataFrame(rows, "id long, prompt string, answer string"), "id", "prompt", "answer").collect()
    assert sorted((r["id"], r["defect_type"]) for r in out) == [(1, "empty"), (3, "copied_question"), (3, "copied_question")]


def test_tiling_against_brute_force():
    r = random.Random(5)
    for _ in range(300):
        letters = r.choice(["ab", "abc"])
        a, b = [r.choice(letters) for _ in range(r.randrange(0, 30))], [r.choice(letters) for _ in range(r.randrange(0, 30))]
        ua, ub, want = [False] * len(a), [False] * len(b), 0
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ua[i + k] and not ub[j + k]:
                        k += 1
                    best = max(best, (k, -i, -j))
            if best[0] < 3:
                break
            for x in range(best[0]):
                ua[-best[1] + x] = ub[-best[2] + x] = True
            want += best[0]
        assert pairs.tiled(a, b, 3) == want


def test_winnowing_guarantee():
    r = random.Random(7)
    for _ in range(30):
        shared = "".join(r.choice("abcdefghij") for _ in range(overlap.GRAM + overlap.WINDOW - 1))
        a, b = ("".join(r.choice("klmnop") for _ in range(r.randrange(200))) + shared + "".join(r.choice("qrstu") for _ in range(r.randrange(200))) for _ in range(2))
        assert {h for _, h in overlap.fingerprints(a)} & {h for _, h in overlap.fingerprints(b)}
    assert overlap.fingerprints("") == []
    assert len(overlap.fingerprints("abc")) == 1


def test_chain_goes_up():
    assert overlap.chain([(1, 10), (2, 3), (3, 4), (4, 5), (0, 9)]) == [(2, 3), (3, 4), (4, 5)]
    assert overlap.chain([]) == []


def test_overlaps_against_brute_force(spark):
    r = random.Random(9)
    sentence = lambda: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(14)) + "."
    layout = "INVESTMENT REVIEW of the listed company named below, to be answered in three sentences with one action. "
    base = [[sentence() for _ in range(8)] for _ in range(25)]
    rows, want, n = [], set(), 0
    for i, s in enumerate(base):
        rows.append((n, True, layout + " ".join(s)))
        t = n
        n += 1
        if i % 3 == 0:
            edit = [x.replace("a", "aa", 1).upper() if k % 2 else x for k, x in enumerate(s)]
            rows.append((n, False, layout + "\n".join(edit[4:] + edit[:4])))
            want.add((t, n))
        elif i % 3 == 1:
            rows.append((n, False, layout + " ".join(s)))
            want.add((t, n))
        else:
            rows.append((n, False, layout + " ".join(s[:3] + [sentence() for _ in range(5)])))
        n += 1
    rows += [(900, True, None), (901, False, ""), (902, False, "..."), (903, True, "short"), (904, False, "short"), (905, False, None)]
    want.add((903, 904))
    df = spark.createDataFrame(rows, "id long, train boolean, text string")
    got = overlap.overlap_pairs(*overlap.cross_split_overlaps(df)).collect()
    assert {(x["id_train"], x["id_other"]) for x in got} == want
    assert len(got) == len(want)
    assert overlap.overlap_pairs(*overlap.cross_split_overlaps(df.where("false"))).count() == 0


def _near(spark, *texts):
    """Similarity of each (training text, other text) that is found, by its number."""
    rows = [(2 * k + side, side == 0, t) for k, two in enumerate(texts) for side, t in enumerate(two)]
    got = overlap.overlap_pairs(*overlap.cross_split_overlaps(spark.createDataFrame(rows, "id long, train boolean, text string"))).collect()
    assert all(r["id_other"] == r["id_train"] + 1 for r in got)
    return {r["id_train"] // 2: r["similarity"] for r in got}


def test_repeated_rows_and_long_gaps_are_aligned(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    row = [word() for _ in range(8)]
    repeated = [word() for _ in range(30)] + row * 60
    changed = [*repeated]
    changed[274] = "changed"
    gap = [word() for _ in range(400)]
    edited = [w if not 150 <= i < 250 or i % 4 else "changed" for i, w in enumerate(gap)]
    got = _near(spark, (" ".join(repeated), " ".join(changed)), (" ".join(gap), " ".join(edited)))
    assert got == {0: pytest.approx(509 / 510), 1: pytest.approx(375 / 400)}


@pytest.mark.parametrize("n", [30, 80, 300])
def test_scattered_edits_are_found(spark, n):
    r = random.Random(n)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9)))
    texts, rates = [], []
    for percent in (2, 4, 6, 8, 10, 12):
        for _ in range(40):
            a = [word() for _ in range(n)]
            b = [*a]
            for i in sorted(r.sample(range(n), round(n * percent / 100)), reverse=True):
                b[i : i + 1] = r.choice([[word()], [word()], [word()], [], [b[i], word()]])
            if n > 50 and r.random() < 0.3:
                b = b[n // 2 :] + b[: n // 2]
            texts.append((" ".join(a), " ".join(b)))
            rates.append(percent)
    far = [word() for _ in range(100)]
    texts.append((" ".join(far), " ".join(w if i % 4 else word() for i, w in enumerate(far))))
    got = _near(spark, *texts)
    assert 240 not in got
    for percent in (2, 4, 6, 8, 10, 12):
        mine = [k for k, p in enumerate(rates) if p == percent]
        assert sum(k in got for k in mine) >= 0.95 * len(mine)


def test_links_are_all_that_share_enough(spark):
    """Against all pairs, among texts with a third in one layout and ever more edits."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7)))
    layout, texts = [word() for _ in range(60)], []
    for k in range(24):
        own = [word() for _ in range(r.choice([8, 25, 90, 180]))]
        a = layout + own if k % 3 == 0 else own
        for _ in range(5):
            texts.append(" ".join(a))
            a = [word() if r.random() < 0.05 else w for w in a]
    rows = [(i, i % 2 == 0, t) for i, t in enumerate(texts)]
    want = set()
    for i, tr, s in rows:
        for j, ot, t in rows:
            a, b = overlap.words_of(s), overlap.words_of(t)
            if tr and not ot and a != b and overlap.shares_fingerprints("".join(a), "".join(b)) and 2 * overlap.aligned_words(a, b) >= 0.8 * (len(a) + len(b)):
                want.add((i, j))
    links, members = overlap.cross_split_overlaps(spark.createDataFrame(rows, "id long, train boolean, text string").repartition(5))
    same = {(x["id"], y["id"]) for x in members.collect() for y in members.collect() if x["train"] and not y["train"] and x["class"] == y["class"]}
    got = {(x["id_train"], x["id_other"]) for x in overlap.overlap_pairs(links, members).collect()}
    assert got == want | same
    assert len(want) > 50


def test_frequencies_in_several_levels(spark, monkeypatch):
    monkeypatch.setattr(overlap, "FAN_IN", 2)
    prints = spark.createDataFrame([(k % 2 == 0, k % 3 == 0, [1 << 60, k << 50]) for k in range(40)], "in_train boolean, in_other boolean, tokens array<long>").repartition(7)
    rank, both = overlap.frequencies(prints)
    cell = int(overlap._cells(np.array([1 << 60], np.uint64))[0])
    assert rank[cell] == rank.max() == int(4 * np.log2(1 + 20 + 14)) and both[cell]


def test_common_subsequence_against_table():
    r = random.Random(4)
    for _ in range(80):
        a, b = ([r.choice("abcd") for _ in range(r.randrange(25))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert overlap.common_length(a, b) == table[-1][-1]
        for bits in (1 << 28, 10):
            places = overlap.common_places(a, b, bits)
            assert len(places) == table[-1][-1]
            assert all(a[i] == b[j] for i, j in places)


FIRMS = {
    "a": ["Marlow Tenby Securities", "MARLOW TENBY SECURITIES", "Marlow Tenby Sec.", "Securities - Marlow Tenby", "Marlow Tenbby Securities", "Marlow Tenby Secuirties Ltd", "M.T.S.", "Marlow Tenby"],
    "b": ["Marlow Quilter Trust", "The Marlow Quilter Tr"],
    "c": ["Orwick & Company", "Orwick and Co.", "Orwick"],
}
PEOPLE = {
    "d": ["Nicholas F. Ullenden", "ULLENDEN NICHOLAS F", "Nick Ullenden", "Ullenden, Nicholas", "N. Ullenden", "Nicholas F. Ulelnden", "Hon. Nicholas Ullenden, Jr"],
    "e": ["Emeric S. Ullenden", "Hon. Emeric Ullenden"],
    "f": ["Gréta Solhart-Galfeld", "Greta Solhart Galfeld"],
}


def test_spellings(spark):
    rows = [("firm:0", n) for group in FIRMS.values() for i, n in enumerate(group) for _ in range(20 if i == 0 else 2)]
    rows += [("owner:1", n) for group in PEOPLE.values() for i, n in enumerate(group) for _ in range(5 if i == 0 else 1)]
    rows += [("owner:2", "Nicholas F. Ullenden"), (None, "x"), ("owner:2", None), ("owner:2", "  "), ("owner:2", "&")]
    out = names.link_spellings(spark.createDataFrame(rows, "scope string, name string"))
    got: dict = {}
    for r in out.collect():
        got.setdefault((r["scope"], r["entity"]), set()).add(r["name"])
    want = [set(g) for g in [*FIRMS.values(), *PEOPLE.values()]] + [{"Nicholas F. Ullenden"}]
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))
    n_pairs = names.spelling_pairs(out).count()
    assert n_pairs == sum(len(g) * (len(g) - 1) // 2 for g in want)
    assert names.link_spellings(spark.createDataFrame([], "scope string, name string")).count() == 0


@pytest.mark.parametrize(
    ("groups", "scope"),
    [
        # two generations are two people; the plain name goes with the more frequent
        ([["John T. Smithers Jr.", "Smithers, John T, Jr", "John T. Smithers", "John T. Smithrs Jr"], ["John T. Smithers Sr.", "SMITHERS JOHN T SR"]], "owner:1"),
        ([["Edgar Valmont III"], ["Edgar Valmont II", "Valmont, Edgar II"]], "owner:1"),
        ([["Edgar Valmont Jr.", "Edgar Valmont", "Valmnt, Edgar"]], "owner:1"),
        # any number of words, of missing and of joined ones
        ([["Alpha Brenton Corvane Dellamar Estwick Farrowby Gallimore Hartwin Partners", "Hartwin Gallimore Farrowby Estwick Dellamar Corvane Brenton Alpha Partners", "Alpha Brentn Corvane Dellamar Estwick Farrowby Gallimore Hartwin Ptrs"]], "firm:0"),
        ([["John Ronald Reuel Talkendorf", "J. R. R. Talkendorf"], ["Karla Ronald Talkendorf"]], "owner:1"),
        ([["Anna Van Den Berghem", "Anna Vandenberghem"], ["Anna Bergholm"]], "owner:1"),
        # two slips of the one proper word; letters of names without a designator
        ([["Fensavall Financial Group", "Gensavakl Financial Group"], ["Fensavall Trust"]], "firm:0"),
        ([["Marlowe Standish", "MS"], ["Quentin Barrowby Trust"]], "firm:0"),
    ],
)
def test_who_is_one_and_who_is_not(spark, groups, scope):
    rows = [(scope, n) for g in groups for i, n in enumerate(g) for _ in range(9 if i == 0 else 1 + (len(g) - i))]
    out = names.link_spellings(spark.createDataFrame(rows, "scope string, name string")).collect()
    got: dict = {}
    for r in out:
        got.setdefault(r["entity"], set()).add(r["name"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups))


def test_keys_meet_what_the_channel_reads():
    """Every pair the channel accepts shares a key, but for two slips in one word and one at another's beginning."""
    r = random.Random(2)
    base = ["Nicholas F. Ullenden", "Gretel Solhart", "Marlow Tenby Securities", "Orwick & Company", "William Dorn Estermann"]
    for _ in range(400):
        meant = r.choice(base)
        typed = list(meant)
        for _ in range(r.choice([1, 1, 2])):
            i = r.randrange(1, len(typed))
            if typed[i].isalpha() and typed[i - 1].isalpha():
                typed[i : i + 1] = r.choice([[], [typed[i]] * 2])
        a, b = names.Name("".join(typed)), names.Name(meant)
        if names.channel(a, b) >= names.LIMIT:
            assert {k for k, _ in names.block_keys(a)} & {k for k, _ in names.block_keys(b)}, (typed, meant)


def test_typing_errors():
    assert names.typing("tets", "test") == names.TYPO
    assert names.typing("teest", "test") == names.TYPO
    assert names.typing("tst", "test") == names.TYPO
    assert names.typing("tept", "test") < names.typing("tedt", "test")


def test_rules_on_held_out_documents(spark):
    held = labelled_documents(600, 77)
    df = spark.createDataFrame(held, "kind string, text string")
    out = quality.document_kinds(df, documents=2500).select("kind", "doc_kind").collect()
    right = sum(r["kind"] == r["doc_kind"] for r in out)
    assert right / len(out) > 0.93
    prose = [r for r in out if r["kind"] == "prose"]
    assert sum(r["doc_kind"] == "prose" for r in prose) / len(prose) > 0.95
    assert {r["kind"] for r in out} == set(KINDS)


def test_statistics_of_small_texts(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, " \n\t", 5), (4, "The cat sat.\nNo more", 5), (5, "x " * 60_000, 5)], "id long, text string, stats int")
    out = {r["id"]: r["stats"] for r in quality.statistics(df.drop("stats")).collect()}
    assert out[1] is None and out[2] is None and out[3] is None
    s = out[4]
    assert (s["n_words"], s["n_lines"], s["end_punctuation_share"], s["words_per_line"]) == (5.0, 2.0, 0.5, 2.5)
    assert s["mean_word_length"] == pytest.approx(16 / 5)
    assert out[5]["n_words"] == 60_000


def test_induction_finds_a_threshold():
    r = np.random.default_rng(0)
    x = np.zeros((400, len(quality.STATISTICS)))
    x[:, 2] = r.random(400)
    kinds = ["table" if v > 0.6 else "prose" for v in x[:, 2]]
    rules = quality.induce(x, kinds)
    assert rules[0][0] == "table"
    assert rules[0][1][0][0] == 2
    assert 0.55 < rules[0][1][0][2] < 0.65
    assert "CASE" in quality.rules_to_case(rules)
