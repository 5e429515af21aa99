"""Centroid clustering, the Jaccard join and spelling variants against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tickerpulse.llm import centroids, jaccard_join, kdtree, licenses, quality, spelling
from tickerpulse.llm.queries import ORACLES, QUERIES

from . import brute
from .test_operators import empty, instances, odd, odd_rows  # noqa: F401

NAN, INF = float("nan"), float("inf")


# --- centroids --------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, width, scale, seed):
    kept = [
        (i, tuple(int(np.floor(scale * x)) for x in v))
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    )
    centres = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, group in groups.items():
            centres[j] = [sum(c) // len(group) for c in zip(*group, strict=True)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = Counter()
    for _, j, d in placed:
        total[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, j, d, total[j], sum(total.values()), digest[j]) for i, j, d in placed), key=repr
    )


def clusters(spark, rows, **options):
    df = spark.createDataFrame(
        [(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string"
    )
    return sorted((tuple(r) for r in centroids.cluster(df.repartition(3), **options).collect()), key=repr)


OPTIONS = {"k": 3, "rounds": 10, "width": 2, "scale": 8, "seed": 3}


def test_clusters_as_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-9, 9), rng.choice([-1.0, 0.0, 2.5])]) for i in range(60)]
    rows += [(7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, None), (9, [1.0]), (10, [1.0, None])]
    rows += [(11, [NAN, 1.0]), (12, [1.0, -INF]), (13, []), (None, [0.5, 0.5])]
    assert clusters(spark, rows, **OPTIONS) == plain_clusters(rows, **OPTIONS)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.0, 1.0])], [(1, [2.0, 1.0])] * 9])
def test_few_or_equal_vectors(spark, rows):
    assert clusters(spark, rows, **OPTIONS) == plain_clusters(rows, **OPTIONS)


def test_a_cluster_that_empties_keeps_its_centroid(spark):
    for seed in range(12):
        rng = random.Random(seed)
        rows = [(i, [rng.choice([0.0, 0.1, 30.0]), rng.choice([0.0, 0.2])]) for i in range(12)]
        options = OPTIONS | {"k": 6, "seed": seed, "rounds": 3}
        assert clusters(spark, rows, **options) == plain_clusters(rows, **options)


def test_components_that_cannot_be_squared_are_refused(spark):
    with pytest.raises(ValueError, match="beyond"):
        clusters(spark, [(1, [1e12, 0.0])], **OPTIONS)


def test_clustering_runs_no_python_on_executors(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    stored = centroids.integer_vectors(vectors, 64, 1024, "vec_id", "embedding")
    plan = centroids.assigned(stored, [[0] * 64, [1] * 64])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- Jaccard join -----------------------------------------------------------------------------


def joined(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.components(df.repartition(5), **options).collect()
    assert len(found) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(w if x > share else f"n{rng.randrange(10**6)}")
        if x > 1 - share / 3:
            out.append(f"i{rng.randrange(10**6)}")
    return " ".join(out)


def family(rng, first, size, n, share):
    """Edited copies of one text, among them copies of copies."""
    base = [f"w{first}x{rng.randrange(400)}" for _ in range(n)]
    texts = [" ".join(base)]
    for _ in range(size - 1):
        source = texts[rng.randrange(len(texts))].split() if rng.random() < 0.4 else base
        texts.append(edited(rng, source, share))
    return texts


@pytest.mark.parametrize(("share", "width"), [(0.01, 5), (0.03, 5), (0.06, 2), (0.12, 1)])
def test_links_as_brute_force(spark, share, width):
    rng = random.Random(int(share * 100))
    texts = [t for f in range(4) for t in family(rng, f, 45, rng.randrange(30, 160), share)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"u{i}v{j}" for j in range(rng.randrange(5, 200))) for i in range(60)]
    texts += texts[:20] + ["one", "One", "two words", "", " \n", "a b c d", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = brute.components(rows, width)
    assert len({root for _, root in expected.values()}) < len(rows)
    assert joined(spark, rows, width=width) == expected


def test_small_slices_and_salts_lose_nothing(spark, monkeypatch):
    """Groups that are cut into many slices, and shingles that are dealt over many tasks."""
    monkeypatch.setattr(jaccard_join, "SLICE", 300)
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", 3)
    rng = random.Random(5)
    texts = family(rng, 1, 150, 80, 0.05) + family(rng, 2, 60, 40, 0.03) * 2
    rows = list(enumerate(texts))
    assert joined(spark, rows) == brute.components(rows, 5)


def test_only_copies_of_hot_shingles(spark, monkeypatch):
    """A class whose copies fill a batch is no reason to lose it beside other classes."""
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", 3)
    base = [f"w{i}" for i in range(40)]
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (0, 39)]
    rows = list(enumerate([" ".join(base)] * 50 + near * 9 + ["w1 w2 w3 w4 w5 w6"] * 5))
    assert joined(spark, rows) == brute.components(rows, 5)


def test_merge_skip_counts_lists():
    rng = random.Random(2)
    for _ in range(200):
        lists = [sorted(rng.sample(range(30), rng.randrange(1, 12))) for _ in range(rng.randrange(1, 9))]
        owners, spans = [], []
        for x in lists:
            spans.append((len(owners), len(owners) + len(x)))
            owners += x
        for least in (1, 2, 4):
            counts = Counter(x for one in lists for x in one)
            expected = sorted((x, n) for x, n in counts.items() if n >= least)
            assert sorted(jaccard_join.merge_skip(owners, spans, least)) == expected


def test_differences_hold_the_bound():
    """A link between sets that are not both linked with a hub shares a differing shingle."""
    rng = random.Random(3)
    for _ in range(3000):
        universe = range(rng.randrange(2, 14))
        hub, a, b = ({x for x in universe if rng.random() < p} for p in (0.8, 0.7, 0.7))
        if not (hub and a and b):
            continue

        def linked(x, y):
            return 100 * len(x & y) >= 80 * len(x | y)

        if linked(a, b) and not (linked(a, hub) and linked(b, hub)):
            assert (a ^ hub) & (b ^ hub)


def test_join_of_odd_rows(spark, odd):  # noqa: F811
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = Counter(tuple(r) for r in jaccard_join.components(odd).collect())
    plain = brute.components([(i, t) for i, t in dict(rows).items() if i is not None], 5)
    expected = Counter()
    for i, t in rows:
        expected[(i, len(brute.shingles(t, 5)), None if i is None else plain[i][1])] += 1
    assert got == expected


def test_join_of_nothing(spark, empty):  # noqa: F811
    assert jaccard_join.components(empty).count() == 0


def test_rows_of_one_id_are_judged_by_their_text(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "p q r s t u"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.components(df).collect())
    assert got == Counter([(1, 1), (1, 1), (2, 1), (3, 3), (3, 3)])


# --- spelling ---------------------------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, slip=199, least_length=6, least_count=5, ratio=5):
    counts = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            word = brute.lower(run)
            h = zlib.crc32(f"{'null' if i is None else i}:{word}".encode())
            if h % slip == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= least_count and len(w) >= least_length}
    close = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            close[a].append(b)
            close[b].append(a)
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(close[w]), words.get(form[w])))
    return out


def found_variants(spark, rows, **options):
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, word string")
    found = [tuple(r) for r in spelling.variants(df.repartition(3), **options).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_variants_as_brute_force(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abél") for _ in range(rng.randrange(5, 9))) for _ in range(30)]

    def slip(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w[:i] + rng.choice("abÿl") + w[i:], w[:i] + w[i + 1 :], w[:i] + "l" + w[i + 1 :]])

    rows = []
    for d in range(120):
        words = [rng.choice(base[: 1 + rng.randrange(30)]) for _ in range(40)]
        rows.append((d, " ".join(slip(w) if rng.random() < 0.2 else w.upper() for w in words)))
    for options in ({}, {"slip": 3, "least_count": 1, "ratio": 2, "least_length": 4}):
        expected = plain_variants(rows, **options)
        assert any(f for _, f, *_ in expected)
        assert found_variants(spark, rows, **options) == expected


def test_forms_are_followed_to_the_end(spark):
    text = " ".join(
        [*["aaaaaa"] * 400, *["aaaaab"] * 70, *["aaaabb"] * 12, *["aaabbb"] * 2, "ÀÀÀÀÀÀ " * 9]
    )
    rows = [(d, text) for d in range(3)]
    expected = plain_variants(rows, slip=10**9)
    assert {w: r for w, _, r, *_ in expected}["aaabbb"] == "aaaaaa"
    assert found_variants(spark, rows, slip=10**9) == expected


def test_repeated_letters_count_once(spark):
    rows = [(1, "hellllo helllo hellllllo " * 5)]
    expected = plain_variants(rows, slip=10**9, least_length=5)
    assert {w: k for w, _, _, _, k, _ in expected} == {"hellllo": 1, "helllo": 1, "hellllllo": 0}
    assert found_variants(spark, rows, slip=10**9, least_length=5) == expected


def test_variants_of_odd_rows(spark):
    rows = [(None, "Nothing here " * 6), (None, "Nothing here " * 6), (1, None), (2, ""), (3, "×÷ 12 ?!"),
            (4, "longword" * 9000 + " " + "longword " * 300), (4, "longwerd " * 9), (5, "ābcdefg " * 9)]
    expected = plain_variants(rows)
    assert "longword" in {w for w, *_ in expected}
    assert found_variants(spark, rows) == expected
    assert found_variants(spark, []) == set()


def test_very_long_words(spark):
    long = "".join(random.Random(8).choice("abcdefgh") for _ in range(3000))
    other = [long[:i] + x + long[i + k :] for i, x, k in ((1500, "é", 1), (0, "", 1), (3000, "x", 0), (50, "q", 0))]
    rows = [(d, " ".join([*[long] * 30, *[w for w in other for _ in range(5)]])) for d in range(2)]
    expected = plain_variants(rows, slip=10**9)
    assert max(k for _, _, _, _, k, _ in expected) == 4
    assert found_variants(spark, rows, slip=10**9) == expected


def test_queries_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {tuple(r) for r in QUERIES["op13_spelling"](spark, small).collect()}
    assert got == plain_variants(rows)


@pytest.mark.parametrize("name", ["op11_centroids", "op12_jaccard_join"])
def test_queries_against_sql(spark, small, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    got = QUERIES[name](spark, small)
    expected = connection.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(expected.columns)
    rows = expected.fetchall()
    order = [expected.columns.index(c) for c in names]
    assert Counter(tuple(r[i] for i in order) for r in rows) == Counter(
        tuple(r) for r in got.select(*names).collect()
    )


# --- line dedup ---------------------------------------------------------------------------------


def test_line_dedup_leaves_columns_of_any_name(spark):
    from tickerpulse.llm import line_dedup

    text = "a\nb\nc\nd"
    names = ["_lines", "_line_id", "_covered", "row", "possible", "covered", "cover_id", "body", "_row"]
    rows = [(i, text if i < 3 else None, *[f"{n}{i}" for n in names]) for i in range(4)]
    schema = ", ".join(["doc_id long", "text string", *(f"`{n}` string" for n in names)])
    df = spark.createDataFrame(rows, schema)
    got = line_dedup.drop_repeated_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert [by_id[i]["text"] for i in range(4)] == [text, "", "", None]
    assert all(tuple(by_id[i][n] for n in names) == rows[i][2:] for i in range(4))
    assert [by_id[i]["n_removed"] for i in range(4)] == [0, 4, 4, 0]


def test_line_dedup_shuffles_no_untouched_text(spark, small):
    from tickerpulse.llm.common import documents
    from tickerpulse.llm import line_dedup

    docs = documents(spark, small)
    plan = line_dedup.drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "Python" not in plan and "Arrow" not in plan
    assert plan.index("Union") < plan.index("SortMergeJoin")


# --- token store --------------------------------------------------------------------------------


@pytest.mark.parametrize("end_id", [None, 2])
@pytest.mark.parametrize("block_ids", [2, 3, 65_536])
def test_token_store_keeps_documents_without_ids(spark, end_id, block_ids):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tickerpulse.llm import token_store
    from tickerpulse.workspace import scratch_path

    path_of = public_tokenizers.path("byte_bpe_50k.json")
    encode = Tokenizer.from_file(path_of).encode
    for rows in ([(1, "a b"), (2, "")], [(1, ""), (2, "")], [(0, None), (1, "a b c"), (2, ""), (3, "d"), (4, "")]):
        path = scratch_path(spark, "store")
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        token_store.write_store(df, path, path_of, end_id=end_id, block_ids=block_ids)
        got = sorted(tuple(r)[:4] for r in token_store.read_store(spark, path).collect())
        want, start = [], 0
        for i, t in rows:
            ids = encode(t or "", add_special_tokens=False).ids + ([] if end_id is None else [end_id])
            want.append((i, start, len(ids), brute.crc(ids)))
            start += len(ids)
        assert got == want


def test_rows_of_one_id_are_split(spark):
    import public_tokenizers

    from tickerpulse.llm import token_store
    from tickerpulse.workspace import scratch_path

    path = scratch_path(spark, "store")
    df = spark.createDataFrame([(None, f"text {i}") for i in range(400)], "doc_id long, text string")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merged)
    spark.conf.set(merged, "false")  # Else Spark joins what is small here.
    token_store.write_store(df.repartition(4), path, public_tokenizers.path("byte_bpe_50k.json"))
    spark.conf.set(merged, before)
    shards = spark.read.parquet(f"{path}/blocks").select("shard").distinct().count()
    assert shards > 1 and token_store.read_store(spark, path).count() == 400


def test_ids_of_texts_with_any_white_space():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tickerpulse.llm import token_store, units

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(6)
    spaces = [" ", "\n", "  ", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\0"]
    parts = ["word", "Wort", "don't", "<|endoftext|>", "12", "\U0001fae0", "é", "..."]
    texts = ["", " ", "\n", "a", "a ", " a", "a\n", "\na", "a b\nc", "a\n b", "a \nb"]
    for _ in range(300):
        some = spaces[: rng.choice([1, 2, 2, len(spaces)])]
        texts.append("".join(rng.choice(parts) + rng.choice([*some, ""]) for _ in range(rng.randrange(9))))
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    cache = units.IdCache(token_store._unit_encoder(path), 40)
    for at in range(0, len(texts), 37):
        ids, counts = cache.ids(pa.array(texts)[at : at + 37])
        assert counts.tolist() == [len(w) for w in want[at : at + 37]]
        assert ids.tolist() == [i for w in want[at : at + 37] for i in w]
    ids, counts = cache.ids(pa.array([], pa.string()))
    assert len(ids) == len(counts) == 0


# --- fences and best-first search ---------------------------------------------------------------


def test_quality_fences_where_most_values_are_zero(spark):
    """Few texts show symbols: the fence lies half-way to them, and follows each source."""
    far = {"loud": 20, "quiet": 8}
    rows = []
    for n, (source, symbols) in enumerate(far.items()):
        for i in range(2_000):
            words = [f"word{chr(97 + (i + k) % 26)}" for k in range(20)]
            marks = ["#" * symbols] if i % 50 == 0 else []
            rows.append((10_000 * n + i, " ".join(words + marks), "en", source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    fences = {r["_s"]: r["symbol_rate_high"] for r in quality.thresholds(quality.measures(docs)).collect()}
    for source, symbols in far.items():
        assert fences[source] == pytest.approx(0.5 * symbols / 21, rel=0.1)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert [i for i, k in kept.items() if not k] and all(
        k == (i % 50 != 0) for i, k in kept.items()
    )


def test_small_groups_follow_their_language(spark):
    """A group's fence is the weighted mean of its own and its language's, without a jump."""
    rows = [
        (i, " ".join(f"{'x' * (3 + i % 3)}{k}" for k in range(12)), "en", "large") for i in range(900)
    ]
    rows += [(2_000 + i, " ".join("y" * 30 + str(k) for k in range(12)), "en", "small") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    fences = {r["_s"]: r["word_length_high"] for r in quality.thresholds(quality.measures(docs)).collect()}
    own = (30 * 12 + 14) / 12 + 6
    # The language has the corpus's fence here, as it is the only one.
    language = fences["large"]
    assert fences["small"] == pytest.approx((4 * own + 40 * language) / 44, rel=0.02)


@pytest.mark.parametrize("width", [3, 64])
def test_best_first_search_prunes_clusters(width):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (64, width))
    points = np.floor(256 * (centres[rng.integers(0, 64, 8_192)] + rng.normal(0, 0.05, (8_192, width))))
    tree = kdtree.Tree(np.arange(8_192), points)
    queries = points[::50]
    probe = kdtree.Best(np.full(len(queries), -1), 5)
    assert kdtree.search(tree, queries, probe, only_best_leaf=True) == len(queries)
    best = kdtree.Best(np.full(len(queries), -1), 5, probe.scores[:, -1])
    visits = kdtree.search(tree, queries, best)
    assert visits < 0.15 * len(queries) * len(tree.leaves)
    assert (best.scores == -np.sort(-(queries @ points.T), axis=1)[:, :5]).all()


# --- hand-written license signatures ------------------------------------------------------------


def test_every_hand_written_signature_is_detected():
    gated, rules = licenses.by_keyword(), licenses.hand_written()
    assert len({r.pattern for r in rules}) == len(rules) > 200
    for rule in rules:
        # A bounded gap between two parts of a sentence stands for one word.
        plain = re.sub(rb"\.\{1,\d+\}\?", b"gap", rule.pattern.pattern)
        for line in instances(re.compile(plain)):
            assert rule.pattern.search(line) and rule.keyword in line, (rule, line)
            found = licenses.detections(line, gated)
            assert rule.label in {r.label for *_, r in found}, (rule, line)


@pytest.mark.parametrize(
    "text, want",
    [
        ("SPDX id BSD-3-Clause", {"bsd"}),
        ("Apache 2.0", {"apache"}),
        ("License: MIT", {"mit"}),
        ("0BSD", {"0bsd"}),
        ("the SIL Open Font License, Version 1.1", {"ofl"}),
        ("SSPL", {"sspl"}),
        ("EUPL-1.2", {"eupl"}),
        ("Business Source License 1.1", {"busl"}),
        ("CC BY-ND 4.0", {"cc-by-nd"}),
        ("Tous droits réservés.", {"reserved"}),
        ("Redistributions of source code must retain the above copyright notice", {"bsd"}),
        ("we teach ASL at school", set()),
        ("er kam mit dem Zug", set()),
        ("apache helicopters over the artistic quarter", set()),
    ],
)
def test_license_short_forms_and_sentences(text, want):
    line, _ = licenses.line_of(text)
    assert {r.label for *_, r in licenses.detections(line, licenses.by_keyword())} == want


def test_keywords_found_in_one_pass():
    gated = licenses.by_keyword()
    find = licenses.keyword_finder(list(gated))
    texts = ["", "GPLv3 or later, GPL 2.0", "mit license", "Tous droits réservés é", "x" * 5_000]
    texts += [" ".join(k.decode() for k in gated)]
    for text in texts:
        line, _ = licenses.line_of(text)
        held = find(line)
        assert held == {k for k in gated if k in line}
        assert set(licenses.detections(line, gated, held)) == set(licenses.detections(line, gated))
