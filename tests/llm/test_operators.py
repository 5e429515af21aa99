import hashlib
import math
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerpulse.llm import (
    bpe,
    kdtree,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    token_store,
    toxicity,
    units,
    warc,
)
from tickerpulse.llm.queries import ORACLES, QUERIES
from tickerpulse.workspace import scratch_path

from . import brute

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "start string, kept string, n_tokens string, label string, covered string, pos string"
)


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows, columns with clashing names."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    texts = [
        (1, base + " thirteen"),
        (2, base + " Fourteen"),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "word"),
        (7, "WORD"),
        (8, "a b"),
        (9, "x\ny\nz\nx\ny\nz\nx\ny\nz"),
        (10, "same\n" * 40),
        (11, "p\nx\ny\nz\nq"),
        (12, "idiot " * 9 + "<|endoftext|> CC-BY, all rights  reserved. MIT License"),
        (13, "long" * 30_000 + " " + "w " * 9_000),
        (14, "café ü \U0001fae0 \x1c!\x1c! 中文 İı"),
        (14, "café ü \U0001fae0 \x1c!\x1c! 中文 İı"),
        (15, "\x00 \x00a\r\nb  c"),
    ]
    rows = [(i, t, "en", "s", 0, "c", "c", "c", "c", "c", "c") for i, t in texts]
    rows.append((16, "no lang", None, None, None, None, None, None, None, None, None))
    rows.append((None, "no id here", "en", None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (6, 1, 0), (12, 0, 1), (None, 0, 1), (8, 1, None)],
        "doc_id long, quality int, toxic int",
    )


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r)))


# --- tokens -------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("block_ids", [64, 65_536])
def test_token_store_round_trip(spark, odd, bits, block_ids):
    path = scratch_path(spark, "store")
    token_store.write_store(odd, path, TOKENIZER, block_ids=block_ids, bits=bits)
    got = token_store.read_store(spark, path).orderBy("start").collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    assert len(got) == len(rows)
    for have, row in zip(got, rows, strict=True):
        ids = [*encode(row[1] or "", add_special_tokens=False).ids, 2]
        assert tuple(have) == (row[0], start, len(ids), brute.crc(ids))
        start += len(ids)
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert sum(r["n_ids"] for r in index) == start
    assert all(len(r["plane_bytes"]) == (32 if bits else 4) for r in index)


def test_token_store_empty(spark, empty):
    path = scratch_path(spark, "store")
    token_store.write_store(empty, path, TOKENIZER)
    assert token_store.read_store(spark, path).collect() == []


def test_token_store_on_documents(spark, small):
    got = QUERIES["op1_token_store"](spark, small).orderBy("start").collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    start = 0
    for have, (doc_id, text) in zip(got, documents(small), strict=True):
        ids = [*encode(text, add_special_tokens=False).ids, 2]
        assert tuple(have) == (doc_id, start, len(ids), brute.crc(ids))
        start += len(ids)


def documents(small):
    query = f"SELECT doc_id, text FROM '{small}/documents.parquet' ORDER BY doc_id"
    return duckdb.sql(query).fetchall()


def check_bpe(rows, got):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest(),
            )
        )
    assert by_id(map(tuple, got)) == by_id(want)


def test_bpe_on_documents(spark, small):
    check_bpe(documents(small), QUERIES["op4_bpe"](spark, small).collect())


def test_bpe_odd_rows(odd, empty):
    check_bpe([r[:2] for r in odd_rows()], bpe.encode_decode(odd, TOKENIZER).collect())
    assert bpe.encode_decode(empty, TOKENIZER).collect() == []


def test_bpe_general_output(odd):
    row = bpe.encode_decode(odd, TOKENIZER, texts_out=True).filter("doc_id = 12").first()
    assert 50256 in row["ids"] and row["decoded"] == odd_rows()[11][1]


def test_units_join_to_the_text():
    for row in odd_rows():
        text = row[1] or ""
        assert "".join(map(units.full, units.split(text))) == text


def test_long_units_are_not_kept():
    cache = units.UnitCache(lambda us: [u.strip() for u in us])
    word = "w" * 100
    assert cache.values([f"a {word}"]) == [["a", word]] and word not in cache.known


def test_bpe_overlapping_pairs():
    model, encode = bpe.Bpe(TOKENIZER), Tokenizer.from_file(TOKENIZER).encode
    words = ["a" * n for n in range(1, 40)] + ["=" * 301, "aab" * 50, "ababab", "é" * 17]
    got = model.encode_words([w.encode() for w in words])
    for word, ids in zip(words, got, strict=True):
        assert ids.tolist() == encode(word, add_special_tokens=False).ids


# --- near-duplicates ----------------------------------------------------------------------------


def test_near_duplicates_on_documents(spark, small):
    want = brute.components(documents(small), 2)
    got = QUERIES["op2_near_dedup"](spark, small).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicates_odd_rows(odd, empty):
    got = near_dedup.near_duplicates(odd, width=2).collect()
    found = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    want = brute.components([r[:2] for r in odd_rows() if r[0] is not None], 2)
    assert found == {i: root for i, (_, root) in want.items()}
    assert len(got) == len(odd_rows())
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert near_dedup.near_duplicates(empty).collect() == []
    kept = near_dedup.keep_one(odd, width=2)
    assert kept.columns == odd.columns
    assert sorted(r[0] for r in kept.collect() if r[0]) == [
        i for i in [1, *range(3, 7), *range(8, 14), 14, 14, 15, 16] if found[i] == i
    ]


def test_links_that_do_not_touch_the_bucket_hub(spark):
    """A chain: each text shares 9 in 10 words with the next only, so most links miss the hub."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for step in range(60):
        rows.append((int(rng.permutation(1000)[0]) * 100 + step, " ".join(words)))
        for at in rng.integers(0, 400, 6):
            words[at] = f"n{step}_{at}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, 2).collect()}
    assert got == {i: root for i, (_, root) in brute.components(rows, 2).items()}


def test_connected_components_of_a_path(spark):
    edges = spark.createDataFrame(
        [(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long"
    )
    got = {(r["a"], r["b"]) for r in near_dedup.connected_components(edges).collect()}
    assert got == {(i, 0) for i in range(1, 51)} | {(101, 100)}


# --- lines, packing -----------------------------------------------------------------------------


def test_line_dedup_odd_rows(odd, empty):
    got = line_dedup.drop_repeated_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    want = brute.line_dedup([r[:2] for r in odd_rows() if r[0] not in (14, None)])
    assert {r[0]: r[1] for r in rows if r[0] not in (14, None)} == want
    assert want[9] == "x\ny\nz" and want[10] == "same\nsame\nsame\n" and want[11] == "p\nq"
    assert {r[1] for r in rows if r[0] == 14} == {odd_rows()[13][1]}
    assert {r[1] for r in rows if r[0] is None} == {"no id here", None}
    assert line_dedup.drop_repeated_lines(empty).collect() == []


@pytest.mark.parametrize("group_rows", [4, 50_000])
def test_packing(spark, group_rows):
    rng = np.random.default_rng(1)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(0, 300, 200))]
    rows += [(1000, 1000), (1001, None), (None, 5), (3, rows[3][1])]
    lengths = spark.createDataFrame(rows, "doc_id long, length long").repartition(3)
    sizes = (64, 128, 256)
    got = packing.pack(lengths, sizes, group_rows=group_rows).collect()
    assert sum(r["length"] for r in got) == sum(n or 0 for _, n in rows)
    assert len([r for r in got if r["piece"] == 0]) == len(rows)
    bins = {}
    for r in got:
        bins.setdefault(r["bin"], []).append(r)
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: (r["place"], r["length"])):
            assert r["place"] == at
            at += r["length"]
        assert {r["bin_length"] for r in held} == {at}
        fits = [s for s in sizes if s >= at]
        assert {r["capacity"] for r in held} == {fits[0]}
    pieces = sorted((r["piece"], r["start"], r["length"]) for r in got if r["doc_id"] == 1000)
    assert pieces == [(0, 0, 256), (1, 256, 256), (2, 512, 256), (3, 768, 232)]


def test_packing_is_tight():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 900, 5_000)
    _, _, capacities, used = packing.pack_group(lengths, (512, 1024, 2048))
    assert sum(used) == lengths.sum() and sum(used) > 0.99 * sum(capacities)


def test_packing_empty_and_documents(spark, odd, empty, small):
    assert packing.pack(packing.word_lengths(empty)).collect() == []
    lengths = {(r[0], r[1]) for r in packing.word_lengths(odd).collect()}
    assert {(3, 1), (4, 1), (5, 1), (8, 3), (13, 9_002)} <= lengths
    got = QUERIES["op5_packing"](spark, small)
    total = got.agg(F.sum("length")).first()[0]
    assert total == sum(len(brute.SPACE.findall(t)) + 1 for _, t in documents(small))


def test_long_passage_in_two_lines_stays(spark):
    """The stated limit of the three-line window."""
    passage = " ".join(f"a{k}" for k in range(40)) + "\n" + " ".join(f"b{k}" for k in range(40))
    rows = [(i, f"first {i}\n{passage}\nlast {i}") for i in range(2)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == {0: 0, 1: 0}


# --- toxicity -----------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, folder)
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.filter("held_out").join(marks, "doc_id").select("predicted", "toxic").collect()
    right = sum(p == t for p, t in rows)
    assert len(rows) > 900 and right >= 0.97 * len(rows)
    hits = [p for p, t in rows if t]
    assert sum(hits) >= 0.8 * len(hits)


def test_toxicity_odd_rows(spark, odd, empty, labels):
    got = toxicity.score(odd, labels).collect()
    assert len(got) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.score(odd, none).collect()} == {0.5}
    assert toxicity.score(empty, labels).collect() == []


def test_toxicity_lexicon_survives_copies(spark):
    insults = "idiot trash moron clown scum".split()
    rows = [
        (i, " ".join(f"{w} w{i}x{k} n{(7 * i + k) % 50} {w}" for k, w in enumerate(insults)), 1)
        for i in range(20)
    ]
    rows += [(100 + i, " ".join(f"w{i}x{k} n{k % 50}" for k in range(30)), 0) for i in range(60)]
    copied = rows[0][1] + " and you are all of that again " + " ".join(f"c{k}" for k in range(60))
    copies = [(1000 + i, copied, 1) for i in range(100)]
    near = [(2000 + i, f"{copied} e{i}", 1) for i in range(100)]
    schema = "doc_id long, text string, label int"
    want = {w.encode() for w in insults}
    for extra in ([], copies, copies + near):
        lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows + extra, schema))
        assert want <= set(lexicon) and b"c5" not in lexicon


def test_toxicity_lexicon_in_many_texts(spark):
    """An insult that stands after the same few hundred words thousands of times stays."""
    rows = [
        (i, " ".join(f"n{(31 * i + k) % 40} idiot u{i}x{k}" for k in range(12)), 1)
        for i in range(60)
    ]
    rows += [(100 + i, " ".join(f"n{k % 40} u{i}x{k}" for k in range(30)), 0) for i in range(60)]
    schema = "doc_id long, text string, label int"
    assert b"idiot" in toxicity.learn_lexicon(spark.createDataFrame(rows, schema))


def test_toxicity_features():
    lexicon, second = {b"idiot": 2.0}, frozenset([b"you"])
    row = dict(
        zip(
            toxicity.FEATURES,
            toxicity.features_of("You IDIOT, an id10t and 1d1ot! idiot 2020", lexicon, second),
            strict=True,
        )
    )
    assert row["lexicon_distinct"] == 1 and row["near_second_person"] == 1
    assert row["disguised_hits"] == 2 and row["lexicon_hits"] == math.log1p(2)


# --- archives -----------------------------------------------------------------------------------


def test_warc_odd_pages(spark):
    big, dup = "<p>é\r\n\r\n" + "P*M\x18\0\0\0\0" * 30, "d" * 100
    rows = [
        (1, "http://a/\n b", big, "x"),
        (2, None, None, "x"),
        (3, "http://c", "", None),
        (5, "http://e", dup, "x"),
        (4, "http://d", dup, "x"),
        (4, "http://d", dup, "x"),
        (6, "http://f", "short", "x"),
        (7, "http://g", "short", "x"),
        (None, "http://h", dup, "x"),
        (None, None, "n" * 200, "x"),
        (8, "http://i", "x" * 3_000_000, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, archive_bytes=400)
    got = warc.read_archives(spark, path).collect()
    want = []
    for page_id, _, html, _ in rows:
        raw = (html or "").encode()
        refers = 4 if html == dup and page_id != 4 else None
        kind = "revisit" if refers else "response"
        want.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), kind, refers))
    assert by_id(tuple(r)[:5] for r in got) == by_id(want)
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) > 1
    assert all(bytes(f["content"][:4]) == b"\x5d\x2a\x4d\x18" for f in files)


def test_warc_empty(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(
        spark.createDataFrame([], "page_id long, url string, html string"), path
    )
    assert warc.read_archives(spark, path).collect() == []


# --- licenses, quality --------------------------------------------------------------------------


def base_columns(r):
    return (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])


def test_licenses(spark, odd, empty, small):
    want = {i: brute.license_base(t) for i, t in documents(small)}
    got = QUERIES["op8_licenses"](spark, small).collect()
    assert {r["doc_id"]: base_columns(r) for r in got} == want and len(got) == len(want)
    assert any(r["n_base"] for r in got)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    rows = licenses.scan(odd).collect()
    assert sorted((r["doc_id"] or 0, base_columns(r)) for r in rows if r["doc_id"] != 14) == sorted(
        (i or 0, brute.license_base(t)) for i, t, *_ in odd_rows() if i != 14
    )
    assert next(r for r in rows if r["doc_id"] == 12)["labels"] == "cc-by,mit,reserved"
    assert licenses.scan(empty).collect() == []


def test_license_suppression():
    gated = licenses.by_keyword()
    line, _ = licenses.line_of("Licensed under the Apache License, Version 2.0 (the License)")
    found = licenses.detections(line, gated)
    assert [line[a:b] for a, b, _ in found] == [b"licensed under the apache license version 2 0"]
    assert len(licenses.rules()) > 200


def instances(pattern):
    """Lines that a rule's pattern matches: every branch, each optional part left out and taken."""
    ends = pattern.pattern.decode().removeprefix("(?<= )").removesuffix("(?= )")

    def of(parts):
        out = [""]
        for op, value in parts:
            op = str(op)
            if op == "LITERAL":
                more = [chr(value)]
            elif op == "NOT_LITERAL":
                more = ["x"]
            elif op == "IN":
                kind, first = value[0]
                more = [chr(first if str(kind) == "LITERAL" else first[0])]
            elif op == "BRANCH":
                more = [x for branch in value[1] for x in of(branch)]
            elif op == "SUBPATTERN":
                more = of(value[3])
            else:
                assert op == "MAX_REPEAT"
                low, high, inner = value
                more = [x * n for x in of(inner) for n in {low, max(1, low) if high > low else low}]
            out = [a + b for a in out for b in dict.fromkeys(more)]
        return out

    return [f" {x} ".encode() for x in of(re._parser.parse(ends))]


def test_every_license_rule_passes_its_gate():
    gated, rules = licenses.by_keyword(), licenses.rules()
    assert len(rules) == 742
    for rule in rules:
        for line in instances(rule.pattern):
            assert rule.pattern.search(line) and rule.keyword in line, (rule, line)
            found = licenses.detections(line, gated)
            assert (1, len(line) - 1, rule.label) in [(a, b, r.label) for a, b, r in found]


@pytest.mark.parametrize(
    "text, want",
    [
        ("licensed under the Berkeley Software Distribution License", {"bsd"}),
        ("Creative Commons Attribution ShareAlike 4.0", {"cc-by-sa"}),
        ("Creative Commons Attribution-Share Alike", {"cc-by-sa"}),
        ("under the terms of the Expat License", {"mit"}),
        ("ASL 2.0", {"apache"}),
    ],
)
def test_license_names_without_their_family_word(text, want):
    line, _ = licenses.line_of(text)
    assert {r.label for *_, r in licenses.detections(line, licenses.by_keyword())} == want


def check_counts(rows, got):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = [(i, *brute.quality_counts(t)) for i, t in rows]
    assert by_id((r["doc_id"], *(r[n] for n in names)) for r in got) == by_id(want)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality(spark, odd, empty, small):
    check_counts(documents(small), QUERIES["op9_quality"](spark, small).collect())
    check_counts([r[:2] for r in odd_rows()], quality.judge(odd).collect())
    assert quality.judge(empty).collect() == []


def test_quality_follows_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op9_quality"](spark, folder).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id"
    )
    rows = got.select("kept", "quality").collect()
    good = [k for k, q in rows if q]
    bad = [k for k, q in rows if not q]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_quality_fences_against_exact_quantiles(spark):
    rows = [(i, "word " * 10 + "x" * (i % 7), "en", "a") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = quality.measures(docs)
    fence = quality.thresholds(measured).first()["word_length_high"]
    values = sorted(r["word_length"] for r in measured.collect())
    middle, upper = values[149], values[224]
    assert fence == pytest.approx(middle + max(6.0, 6 * (upper - middle)), abs=0.05)


def capitals_text(i, rate):
    """Twenty words of ten letters; a share of all letters are capitals."""
    words = [f"{chr(97 + (i + k) % 26)}bcdefghij" for k in range(20)]
    letters = "".join(words)
    letters = letters[: round(200 * rate)].upper() + letters[round(200 * rate) :]
    return " ".join(letters[k : k + 10] for k in range(0, 200, 10))


def test_quality_fences_follow_the_spread(spark):
    """Two sources with one median of capitals: the wide one's fence lies further out."""
    steps = {"narrow": 0.005, "wide": 0.02}
    rows = [
        (1000 * n + i, capitals_text(i, 0.2 + step * (i % 21 - 10)), "en", source)
        for n, (source, step) in enumerate(steps.items())
        for i in range(420)
    ]
    rows += [(9000 + n, capitals_text(3, 0.5), "en", source) for n, source in enumerate(steps)]
    lines = [f"unique{k:04d}" for k in range(24)]
    rows += [(9100, "\n".join(lines), "en", "narrow")]
    lines[::2] = ["abcdefghij"] * 12
    rows += [(9101, "\n".join(lines), "en", "narrow")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = quality.measures(docs)
    fences = {r["_s"]: r["capital_rate_high"] for r in quality.thresholds(measured).collect()}
    for source in steps:
        own = measured.filter(F.col("source") == source).collect()
        values = sorted(r["capital_rate"] for r in own)
        middle, upper = (values[round(q * len(values)) - 1] for q in (0.5, 0.9))
        assert fences[source] == pytest.approx(middle + 4 * (upper - middle), rel=0.15)
    assert fences["wide"] - 0.2 > 2 * (fences["narrow"] - 0.2)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert not kept[9000] and kept[9001]
    assert kept[9100] and not kept[9101]


# --- top-k --------------------------------------------------------------------------------------


def brute_top(rows, is_query, k):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = []
    for q in sorted({i for i, _ in usable if is_query(i)}):
        own = min([v for j, v in rows if j == q and ok(v)])
        vec = [math.floor(256 * x) for x in own]
        found = [
            (-sum(a * b for a, b in zip(vec, v, strict=True)), i)
            for i, v in usable
            if i != q and len(v) == len(vec)
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("spread", [2, 300])
def test_top_k(spark, spread):
    rng = np.random.default_rng(spread)
    rows = [
        (int(i), [float(x) for x in rng.integers(-spread, spread, 6) / 256]) for i in range(700)
    ]
    rows += [(1000 + i, [0.01] * 6) for i in range(400)]
    rows += [(2000, None), (2050, [1.0, None, 1.0, 0.0, 0.0, 0.0]), (2100, [math.nan] * 6)]
    rows += [(2150, [math.inf] * 6), (2200, []), (2201, []), (2250, [1.0, 2.0]), (None, [1.0] * 6)]
    rows += [(50, [0.5] * 6), (2300, [1e18, 1.0]), (2301, [1.0, -1e18])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit("clash")
    )
    got = kdtree.top_k(df.repartition(3), F.col("vec_id") % 50 == 0, 5, query_block=7).collect()
    want = brute_top(rows, lambda i: i % 50 == 0, 5)
    long = 2**63 - 1
    want = [(q, r, i, max(-long, min(long, s))) for q, r, i, s in want]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kdtree.top_k(df, F.col("vec_id") % 50 == 0).collect() == []


def test_search_visits_few_leaves():
    rng = np.random.default_rng(0)
    points = np.floor(rng.normal(0, 40, (4_096, 3)) * 4)
    tree = kdtree.Tree(np.arange(4_096), points)
    queries = np.floor(rng.normal(0, 40, (32, 3)))
    best = kdtree.Best(np.full(32, -1), 5)
    visits = kdtree.search(tree, queries, best)
    assert visits < 0.5 * 32 * len(tree.leaves)
    assert (best.scores == -np.sort(-(queries @ points.T), axis=1)[:, :5]).all()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13
