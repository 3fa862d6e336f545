import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terrane.llm import decontaminate, mixing, queries, simhash, token_shards
from terrane.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def some_docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, None) for i, t in enumerate(texts)], DOCS)


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("crowd", [1, 32])
def test_simhash_matches_brute_force(spark, crowd):
    r = random.Random(1)
    base = [" ".join(r.choices("alpha beta gamma delta épsilon Zeta eta".split(), k=40)) for _ in range(12)]
    texts = [None, "", "a", "A b", " \t"]
    for b in base:
        w = b.split()
        for _ in range(6):
            v = list(w)
            v[r.randrange(40)] = r.choice(["x", "y", "BETA"])
            texts.append(" ".join(v))
    texts += base * 2
    got = simhash.simhash_components(some_docs(spark, texts), crowd=crowd).withColumn("hex", simhash.fingerprint_hex(F.col("fp"))).collect()
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    want = plain_components(fps, range(len(texts)))
    assert len(got) == len(texts)
    for row in got:
        assert row.hex == f"{fps[row.doc_id]:016x}"
        assert row.component_id == want[row.doc_id]


def test_close_pairs_misses_no_link_near_random_points(spark):
    r = random.Random(2)
    seeds = [r.getrandbits(64) for _ in range(20)]
    fps = set(seeds) | {0, (1 << 64) - 1, 1}
    for s in seeds:
        for _ in range(12):
            fps.add(s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    for crowd in (2, 500):
        edges = simhash.close_pairs(spark.createDataFrame([(f,) for f in signed], "fp long"), crowd).collect()
        assert all(bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2 for a, b in edges)
        linked = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
        label = {f: f for f in signed} | {x.node: x.component for x in linked}
        want = plain_components({f: f & ((1 << 64) - 1) for f in signed}, sorted(signed))
        assert label == want


def test_keep_one_keeps_one_row_of_each_group(spark):
    df = some_docs(spark, ["a b c d", "a b c d", None, "x y z q", "a b c d"])
    df = df.union(df)
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == [0, 2, 3]
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_components_of_chains_hubs_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in (200, 201, 202)}


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_meets_its_targets(spark):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * int(r.paretovariate(1.2))) if i % 50 else None, "en", r.choice(["b", "a", "é", None, "z", "a", "a"]), 0) for i in range(3000)]
    got = mixing.mix_counts(spark.createDataFrame(rows, DOCS), cell_rows=100).collect()
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    source = {row[0]: row[3] for row in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sizes[source[i]] += n
    want = plain_targets(sizes)
    assert len(got) == 3000
    for row in got:
        s = source[row.doc_id]
        assert row.size == size[row.doc_id] and row.source_size == sizes[s]
        assert row.target == pytest.approx(want[s]) and row.taken in (0, row.size, 2 * row.size)
        taken[s] += row.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(size.values()) + 0.03 * want[s]
    again = mixing.mix_counts(spark.createDataFrame(rows[::-1], DOCS).repartition(5), cell_rows=100).collect()
    assert {x.doc_id: x.taken for x in again} == {x.doc_id: x.taken for x in got}


def test_mix_repeats_rows_and_handles_small_tables(spark):
    df = some_docs(spark, ["a b", None, "c"])
    assert mixing.mix(df).columns == df.columns
    assert mixing.mix_counts(df.limit(0)).collect() == []
    assert [x.taken for x in mixing.mix_counts(some_docs(spark, [None, ""])).collect()] == [0, 0]


def plain_matches(text, items):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    w, hit, found = cut(text), set(), []
    for item, t in items:
        v = cut(t)
        n = min(13, len(v))
        at = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        places = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in at] if n else []
        hit.update(j for i in places for j in range(i, i + n))
        if places:
            found.append(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


def check_matches(spark, docs, items, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    m = F.col("_match")
    out = decontaminate.find_contamination(df, bench, **options)
    out = out.select("doc_id", m["n_words"], m["n_hit"], F.size(m["items"]), F.sha2(F.array_join(m["items"], ","), 256), decontaminate.contaminated())
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == {i: plain_matches(t, items) for i, t in enumerate(docs)}


def test_decontamination_matches_brute_force(spark):
    r = random.Random(4)
    vocab = "ab Cd é1 f g-h 9 zz".split()
    items = [(i, " ".join(r.choices(vocab, k=r.choice([0, 1, 5, 13, 20, 45])))) for i in range(30)] + [(90, None), (91, "unseen words " * 9)]
    items += [(95, items[3][1]), (96, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen")]
    docs = [None, "", "ab", "ONE, two three-four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"]
    docs += [" ".join(r.choices([*vocab, "q"], k=r.randrange(200))) for _ in range(40)]
    docs += [f"x {items[i][1]} y {items[i][1]}" for i in range(30)]
    check_matches(spark, docs, items)
    check_matches(spark, docs, items, block_bytes=300)
    check_matches(spark, docs, [])
    long_items = [x for x in items if x[1] and len(x[1].split()) > 12]
    check_matches(spark, docs, long_items)


def test_longest_match_and_removal(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(0, "a " + " ".join(f"w{i}" for i in range(4, 25)) + " b"), (1, "clean"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench).orderBy("doc_id").collect()
    assert [r._match.longest for r in got] == [21, 0, 0] and (got[0]._match.starts, got[0]._match.ends) == ([1], [22])
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).orderBy("doc_id").collect()] == [1, 2]


def test_own_columns_never_clash(spark):
    df = some_docs(spark, ["a b", "one two"]).withColumn("_match", F.lit("own")).withColumn("_mix_row", F.lit("own")).withColumn("_mix_copies", F.lit("own")).withColumn("_row", F.lit("own"))
    bench = spark.createDataFrame([(1, "seen words " * 20), (2, "more words " * 20)], "item_id long, text string")
    for block_bytes in (1 << 20, 100):
        got = decontaminate.decontaminate(df, bench, block_bytes=block_bytes)
        assert got.columns == df.columns and {r._match for r in got.collect()} == {"own"}
    with pytest.raises(ValueError):
        decontaminate.find_contamination(df, bench)
    got = mixing.mix(df)
    assert got.columns == df.columns and {r._mix_row for r in got.collect()} <= {"own"}


def test_suffix_array_is_sorted():
    ids = np.array([int(x) for x in "1213121121213120"] + [0] * 20)
    sa = decontaminate.suffix_array(ids, np.arange(15), 16)
    suffixes = [tuple(ids[i : i + 16]) for i in sa]
    assert suffixes == sorted(suffixes)


def test_token_sequences_round_trip(spark):
    texts = [None, "", " ", "a", "Hello  world\n\n x\ty é🙂 don't 123 ", "tail space ", "\n lead", "w " * 3000, "<|endoftext|> x", "日本語 テキスト nb em"]
    df = some_docs(spark, texts).drop("n_chars").withColumn("slot", F.lit(1))
    out = token_shards.training_order(df, length=16, stride=8).cache()
    rows = out.orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows))) and all(r.shard == r.slot // 8 and len(r.tokens) == 32 for r in rows)
    back = {r.doc_id: r.text for r in token_shards.decode(out).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    enc = token_shards.encoder(token_shards.VOCABULARY)
    for t in texts:
        assert np.frombuffer(token_shards.encode(t or "", token_shards.Pieces(enc)), "<u2").tolist() == enc.encode_ordinary(t or "")
    assert token_shards.training_order(df.limit(0)).collect() == []


def test_shards_can_be_read_on_from_any_slot(spark, tmp_path):
    out = token_shards.training_order(some_docs(spark, [f"text number {i} " * 9 for i in range(30)]), length=16, stride=8)
    token_shards.write_shards(out, str(tmp_path / "shards"))
    n = out.count()
    got = token_shards.read_from(spark, str(tmp_path / "shards"), 13, 8).collect()
    assert [r.slot for r in got] == list(range(13, n))


def test_slots_do_not_depend_on_partitions(spark):
    df = some_docs(spark, [f"text number {i} of some length " * (1 + i % 7) for i in range(120)] + [None, "", ""])
    df = df.union(df.where("doc_id % 10 = 0"))

    def slots(n, tasks):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            rows = token_shards.training_order(df.repartition(n), length=16, stride=8).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        return {r.slot: (r.doc_id, r.chunk, bytes(r.tokens)) for r in rows}

    want = slots(1, 8)
    assert slots(7, 8) == want and slots(50, 3) == want
    # The numbers that are permuted are the ranks by hash, then id, chunk and tokens.
    h = spark.createDataFrame([(d, c) for d, c, _ in want.values()], "doc_id long, chunk int").distinct().join(df.select("doc_id", F.xxhash64("doc_id", "text").alias("doc")).distinct(), "doc_id")
    by_key = {(r.doc_id, r.chunk): r.h for r in h.select("doc_id", "chunk", F.xxhash64("doc", "chunk").alias("h")).collect()}
    ranked = sorted(want.values(), key=lambda x: (by_key[x[:2]], x))
    n = len(ranked)
    place = token_shards.feistel(np.arange(n), n, 20_240_229)
    assert {int(place[i]): x for i, x in enumerate(ranked)} == want


def test_copies_are_decoded_each(spark):
    df = some_docs(spark, ["a long text " * 30, "short", None])
    twice = df.union(df.where("doc_id < 2")).union(spark.createDataFrame([(1, "another text of the same id", "en", "s", 0)], DOCS))
    got = sorted((r.doc_id, r.text) for r in token_shards.decode(token_shards.training_order(twice, length=16, stride=8)).collect())
    assert got == sorted([(0, "a long text " * 30)] * 2 + [(1, "short")] * 2 + [(1, "another text of the same id"), (2, "")])


def plain_feistel(x, n, key, rounds=4):
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    full, mask = (1 << 64) - 1, (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for r in range(rounds):
            z = (right + key + r * 0x9E3779B97F4A7C15) & full
            z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & full
            z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & full
            left, right = right, left ^ ((z ^ (z >> 31)) & mask)
        x = (left << half) | right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_feistel_matches_plain_numbers(n):
    assert token_shards.feistel(np.arange(n), n, 99).tolist() == [plain_feistel(i, n, 99) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = token_shards.feistel(np.arange(n), n, 5)
    assert sorted(out) == list(range(n))
    assert n < 100 or (out != token_shards.feistel(np.arange(n), n, 6)).any()


def test_queries_over_given_tables_match_brute_force(spark):
    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = {r[0]: tuple(r)[1:6] for r in queries.op8_decontaminate(spark, SF).collect()}
    assert got == {i: plain_matches(t, items) for i, t in docs}
    fps = {i: plain_fingerprint(t) for i, t in docs}
    want = plain_components(fps, sorted(fps))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash_near_dedup(spark, SF).collect()} == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}
