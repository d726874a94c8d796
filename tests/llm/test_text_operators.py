"""Token counts, quality rules, personal data and packing against brute force, and on awkward rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loanloom.llm import packing, pii, quality_rules, token_count
from loanloom.llm.queries import packed
from .helpers import awkward_rows, clashing, prose, rows_of, table_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_token_counts_of_awkward_rows(spark, pieces):
    docs = clashing(table_of(spark, awkward_rows()))
    got = rows_of(token_count.token_counts(docs, MODEL, limit=100))
    want = []
    for doc_id, text, *_ in awkward_rows():
        n = len(pieces.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 100))
    assert got == sorted(want, key=repr)
    assert token_count.token_counts(docs.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(32, 4), (50, 16), (301, 40)])
def test_chunks_are_spliced_to_the_same_count(pieces, chunk, overlap):
    counter = token_count.ChunkedCounter(MODEL, chunk, overlap)
    draw = random.Random(chunk)
    texts = ["".join(draw.choice(" ab▁é漢\n<s>e th") for _ in range(draw.randint(1, 900))) for _ in range(60)]
    texts += [prose(400, 3), "a" * 2000, " " * 700, "ab" * 500 + " " + "ba" * 400, "\U0001f600" * 300, "▁ " * 200]
    assert counter.counts(texts) == [len(pieces.encode(t)) for t in texts]


def brute_quality(text: str | None) -> tuple:
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed,
    )


def test_quality_counts_against_brute_force(spark):
    draw = random.Random(4)
    rows = awkward_rows() + [
        (100 + i, "".join(draw.choice("a b a b c \n#|é ") for _ in range(draw.randint(0, 300))), "en", "a", 1) for i in range(60)
    ]
    docs = clashing(table_of(spark, rows))
    q = F.col("quality")
    got = quality_rules.assess(docs).select(
        "doc_id", q["n_words"], q["word_chars"], q["n_symbols"], q["lines"]["dup"], q["n_repeat_words"], q["base_failed"]
    )
    assert rows_of(got) == sorted([(r[0], *brute_quality(r[1])) for r in rows], key=repr)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert not {0, 1, 2, 6, 11} & {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


def test_the_given_table_decides(spark):
    docs = table_of(spark, [(1, "one two three four five six", "en", "a", 1), (2, "one two", "en", "a", 1)])
    own = (quality_rules.Rule("n_words", low=3),)
    assert [r["doc_id"] for r in quality_rules.keep_good(docs, own).collect()] == [1]
    judged = quality_rules.assess(docs, own).select("quality.base_failed", "quality.kept").collect()
    assert sorted(map(tuple, judged)) == [(True, False), (True, True)]


def test_quality_keeps_clean_prose_and_rejects_by_each_threshold(spark):
    clean = " ".join(["the river and the stone"] * 0 + [f"the river{i} of stone{i}" for i in range(30)])
    rows = [
        (1, clean, "en", "a", 1),
        (2, " ".join(f"w{i}" for i in range(100)), "en", "a", 1),  # no function words
        (3, " ".join(f"the | n{i}" for i in range(60)), "en", "a", 1),  # symbols
        (4, "\n".join(f"- the item of {i}" for i in range(40)), "en", "a", 1),  # bullets
        (5, " ".join(f"thethethethethethe{i}" for i in range(30)), "en", "a", 1),  # long words
    ]
    kept = {r["doc_id"] for r in quality_rules.keep_good(table_of(spark, rows)).collect()}
    assert kept == {1}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text: str) -> set[tuple]:
    found = {("email", *m.span()) for m in EMAIL.finditer(text)}
    found |= {("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))}
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(digits) <= 19 and sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0:
            found.add(("card", *m.span()))
    return found | {("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15}


def test_base_detectors_equal_the_expressions():
    draw = random.Random(7)
    for alphabet in ("a.@-+ 1234(b9_%", "0123456789 -.+", "ab@.", "4 1-"):
        for _ in range(1500):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60)))
            assert {tuple(s) for s in pii.detect(text)} == brute_base(text), text


@pytest.mark.parametrize(
    "text,kind,part",
    [
        ("write to john.doe (at) site [dot] example [dot] com now", "email", "john.doe (at) site [dot] example [dot] com"),
        ("so john at example dot com it is", "email", "john at example dot com"),
        ("jоhn@ехample.com", "email", "jоhn@ехample.com"),
        ("x ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("to jo\u200bhn@example.com.", "email", "jo\u200bhn@example.com"),
        ("call plus one five five five one two three four five six seven ok", "phone", "plus one five five five one two three four five six seven"),
        ("card four one one one one one one one one one one one one one one one end", "card", " ".join(["four"] + ["one"] * 15)),
        ("ip one nine two dot one six eight dot one dot one x", "ip", "one nine two dot one six eight dot one dot one"),
    ],
)
def test_disguises_are_mapped_back(text, kind, part):
    base, added = pii.find(text)
    spans = [s for s in base + added if s.kind == kind]
    assert part in {text[s.start : s.end] for s in spans}


@pytest.mark.parametrize("text", ["we met at home dot we left", "one of two", "plus one", "Привет мир", "at 10 dot 5", "write to a@b.com dot well", prose(200, 2)])
def test_plain_prose_adds_nothing(text):
    assert pii.find(text)[1] == []


@pytest.mark.parametrize(
    "text,kind,part",
    [
        ("write jane at example.com now", "email", "jane at example.com"),
        ("so jane at mail.example dot com it is", "email", "jane at mail.example dot com"),
        ("so jane at mail dot example.com it is", "email", "jane at mail dot example.com"),
        ("ask john dot smith@example.com ok", "email", "john dot smith@example.com"),
        ("ask john [dot] smith@example.com ok", "email", "john [dot] smith@example.com"),
        ("is jane at example dot me, yes", "email", "jane at example dot me"),
        ("is jane at example dot xyz, yes", "email", "jane at example dot xyz"),
        ("is jane at example dot co dot online.", "email", "jane at example dot co dot online"),
        ("call plus one 555 123 4567 ok", "phone", "plus one 555 123 4567"),
        ("call +one 555 123 4567 ok", "phone", "+one 555 123 4567"),
        ("call plus 1 five 5 five 1 two 3 four 5 six 7 ok", "phone", "plus 1 five 5 five 1 two 3 four 5 six 7"),
        ("card 4 " + "one 1 " * 7 + "one end", "card", "4 " + "one 1 " * 7 + "one"),
    ],
)
def test_mixed_disguises_are_found_whole_and_masked(spark, text, kind, part):
    base, added = pii.find(text)
    assert [text[s.start : s.end] for s in added if s.kind == kind] == [part]
    row = table_of(spark, [(1, text, "en", "a", 1)])
    assert pii.mask_pii(row).first()["text"] == text.replace(part, f"<{kind}>")


@pytest.mark.parametrize("text", ["look at example.com today", "visit us at example.com", "sat at home dot The end", "a@b.com dot then", "one 5 gallon tank", "he sat at the.end"])
def test_prose_with_real_dots_adds_nothing(text):
    assert pii.find(text)[1] == []


def test_pii_of_awkward_rows(spark):
    rows = awkward_rows() + [(50, "mail a@b.co, +1 555 010 99 99 and 10.0.0.1", "en", "a", 1)]
    docs = clashing(table_of(spark, rows))
    found = pii.find_pii(docs.select("doc_id", "text"))
    assert found.count() == len(rows)
    spans = {r["doc_id"]: r["s"] for r in found.select("doc_id", pii.digest(F.col("pii")["spans"]).alias("s")).collect()}
    assert spans[0] == spans[1] == "" and spans[50] == "email:5:11,phone:13:29,ip:34:42"
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in masked.select("doc_id", "text").collect()}
    assert text[50] == "mail <email>, <phone> and <ip>" and text[0] is None and text[7] == dict((r[0], r[1]) for r in rows)[7]
    assert pii.mask_pii(docs.limit(0)).count() == 0


def test_differencing_deals_every_item_once_and_near_equal():
    draw = random.Random(2)
    for _ in range(300):
        sizes = [draw.randint(1, 60) for _ in range(draw.randint(1, 14))]
        count = draw.randint(1, 6)
        windows = packing.difference(sizes, count)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes))) and len(windows) <= count
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert all(sum(w) <= 3 for w in packing.fit([2, 2, 2], 3))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, r[1], *r[2:]) for i, r in enumerate(awkward_rows())] + [(40, "a <|endoftext|> b", "en", "a", 1)]
    rows += [(100 + i, prose(60 + 7 * i, i), "en", "a", 1) for i in range(120)]
    out = packed(clashing(table_of(spark, rows))).withColumn("crc", F.crc32("ids")).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and r["crc"] == zlib.crc32(r["ids"])
        by_doc[r["doc_id"]].append((r["start"], ids))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text, *_ in rows:
        pieces = sorted(by_doc[doc_id], key=lambda p: p[0])
        ids = np.concatenate([p for _, p in pieces])
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert [s for s, _ in pieces] == np.cumsum([0] + [len(p) for _, p in pieces])[:-1].tolist()
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packed(table_of(spark, [])).count() == 0


def test_packing_of_long_runs(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    runs = [" ", "\n", "x", "\u3000", " \n\t", "7", "!"]
    rows = [(i, f"head {run * (1_000_000 // len(run))} tail", "en", "a", 1) for i, run in enumerate(runs)]
    rows.append((20, " " * 99_999 + "a" + "\t" * 100_000, "en", "a", 1))
    by_doc = defaultdict(list)
    for r in packed(table_of(spark, rows).repartition(8)).collect():
        by_doc[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4")))
    for doc_id, text, *_ in rows:
        ids = np.concatenate([p for _, p in sorted(by_doc[doc_id], key=lambda p: p[0])])
        assert (ids == tokenizer.encode(text, add_special_tokens=False).ids + [0]).all()


def test_packing_repeats_rows_and_null_ids(spark):
    rows = [(None, "a b c", "en", "a", 1)] * 3 + [(1, None, None, None, None)] * 2
    out = packed(table_of(spark, rows)).collect()
    assert Counter(r["doc_id"] for r in out) == {None: 3, 1: 2}
