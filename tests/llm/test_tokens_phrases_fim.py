"""Byte-level BPE, collocations and fill-in-the-middle against plain versions."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.llm import byte_bpe, collocations, fill_in_middle, queries

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "\n\n", "a", "a  b", " a b ", "naïve café—日本語 🙂🙂", "it's we'll I'd 100km x²", "\x1c\x85\xa0 a", "x" * 5000, "ab " * 4000, "ՠ࢏ \U00031350 \U00016ea0a", "a\n b\n\nc \n"]


def texts_of(spark, n=120):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").limit(n).collect()
    return [(r["doc_id"], r["text"], r["lang"]) for r in rows]


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(byte_bpe.default_vocabulary()))}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- 11


def test_ids_are_those_of_the_library_and_read_back(spark):
    rnd = random.Random(7)
    texts = ODD + [t for _, t, _ in texts_of(spark)] + ["".join(rnd.choice(" \n\t'sdlabé中🙂09.,-\x1c\xa0") for _ in range(rnd.randrange(80))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = byte_bpe.decode(byte_bpe.encode(rows)).collect()
    plain = tiktoken_encoding()
    for r in got:
        assert r["ids"] == plain.encode_ordinary(texts[r["doc_id"]] or "")
        assert bytes(r["bytes"]) == (texts[r["doc_id"]] or "").encode()


def test_every_kind_of_character_is_cut_as_by_the_library():
    known, plain = byte_bpe.Codec(*byte_bpe._parts(None)), tiktoken_encoding()
    codes = [c for c in (*range(0x3100), *range(0x3100, 0x110000, 101), *range(0x16E00, 0x16F00), *range(0x11DD0, 0x11DF0)) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)} \n{chr(c)}" for c in codes]
    for text, ids in zip(texts, known.encode(texts), strict=True):
        assert ids.tolist() == plain.encode_ordinary(text), hex(ord(text[1]))


def test_long_texts_are_encoded_in_parts(monkeypatch):
    known, plain = byte_bpe.Codec(*byte_bpe._parts(None)), tiktoken_encoding()
    monkeypatch.setattr(byte_bpe, "BLOCK", 100)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 20)
    texts = ["short", "one two  three \n four, " * 500, "y" * 900, ("a" * 60 + "  ") * 30, ""]
    assert [x.tolist() for x in known.encode(texts)] == [plain.encode_ordinary(t) for t in texts]
    assert len(known.known) <= 40


def test_a_vocabulary_with_gaps_is_refused(tmp_path):
    (tmp_path / "v").write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(tmp_path / "v"))


def test_bpe_query_against_the_library(spark):
    plain = tiktoken_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_of_empty_tables_null_ids_and_further_columns(spark):
    assert byte_bpe.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = spark.createDataFrame([(None, "x y", 1), (None, "x y", 1)], "doc_id long, text string, n_tokens int")
    got = byte_bpe.encode(rows).collect()
    assert len(got) == 2 and got[0]["ids"] == got[1]["ids"] and got[0]["n_tokens"] == 1


# --- 12


def plain_collocations(rows, longest=3, least=10, top=2000):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            s, k = min((int(Fraction(1_000_000 * a * a, counts[p[:k]] * counts[p[k:]])), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def phrase_rows(rnd, n=150):
    common = ["new", "york", "city", "Paris", "d'or", "é", "日本", "x"]
    rows = []
    for i in range(n):
        words = rnd.choices(common, k=rnd.randrange(30)) + ["New", "York", "City"] * rnd.randrange(3)
        rows.append((i, "".join(w + rnd.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  ", "!?"]) for w in words), rnd.choice(["en", "fr", None])))
    return rows + [(None, None, "en"), (1, "", "en"), (1, " \t", None), (5, ".,;", "de")]


@pytest.mark.parametrize(("burst", "entries", "size"), [(1 << 14, 1_000_000, 1 << 20), (2, 10, 40), (1, 1, 1)])
def test_collocations_against_a_plain_version(spark, monkeypatch, burst, entries, size):
    monkeypatch.setattr(collocations, "SLICE", size)
    rows = phrase_rows(random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = collocations.collocations(docs, burst=burst, entries=entries).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows)
    few = collocations.collocations(docs, burst=burst, entries=entries, top=3).collect()
    assert sorted(map(tuple, few)) == plain_collocations(rows, top=3)


def test_collocations_of_one_very_long_text_and_many_copies(spark):
    rnd = random.Random(5)
    rows = [(0, " ".join(rnd.choices(["a", "b", "c", "the", "e"], k=60_000)) + "w" * 3_000_000, "en")] + [(i, "one hot pair of words", "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == plain_collocations(rows)


def test_slices_are_cut_at_spaces(monkeypatch):
    data = b"a b c d e f g"
    monkeypatch.setattr(collocations, "SLICE", 4)
    assert b"".join(collocations._slices(data)) == data


def test_trie_bursts_and_spills_whole_subtrees():
    trie = collocations.PhraseTrie(burst=2)
    rnd = np.random.default_rng(4)
    rows = [rnd.integers(0, 9, 60) * 100 for _ in range(30)]  # three groups of first words
    for ids in rows:
        trie.add(collocations._phrases(ids, 0, (1, 2, 3)))
    mask = (1 << 21) - 1
    plain = Counter()
    for ids in rows:
        for m in (1, 2, 3):
            for i in range(len(ids) - m + 1):
                p = ids[i : i + m].tolist()
                if 0 not in p:
                    plain[tuple(p)] += 1
    assert trie.sizes.total() == len(plain)
    assert not isinstance(trie.root[0], Counter) and not isinstance(trie.root[0][100], Counter)
    got, groups = {}, []
    for keep in (len(plain) - 1, 0):
        for keys, counts in trie.spill(keep):
            groups.append(set((keys >> 50).tolist()))
            got |= {tuple(x for x in (k >> 42, k >> 21 & mask, k & mask) if x): n for k, n in zip(keys.tolist(), counts.tolist(), strict=True)}
    assert got == plain and len(groups) > 1 and not groups[0] & set().union(*groups[1:])


def test_pair_filter_has_every_pair(spark):
    rnd = random.Random(6)
    words = [rnd.choice(["é", "日本", "w", "x-"]) + str(i) for i in range(300)]
    pairs = [("en", f"{rnd.choice(words)} {rnd.choice(words)}") for _ in range(2000)]
    held = collocations.PairFilter(spark.createDataFrame(pairs, "lang string, phrase string"), 16)
    hashes = {w: collocations.xxhash.xxh64_intdigest(w.encode(), 42) for w in words}
    known = lambda lang, a, b: held.neighbours(lang, np.array([hashes[a], hashes[b]], np.uint64))[1]
    assert all(known("en", *p.split(" ")) for _, p in pairs)
    others = [(rnd.choice(words), rnd.choice(words)) for _ in range(2000)]
    assert sum(known("fr", a, b) for a, b in others) < 100


@pytest.mark.parametrize("bits", [6, 20])
def test_a_full_filter_does_not_change_the_result(spark, bits):
    rows = phrase_rows(random.Random(9), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, collocations.collocations(docs, filter_bits=bits).collect())) == plain_collocations(rows)
    assert sorted(map(tuple, collocations.collocations(docs, longest=2).collect())) == plain_collocations(rows, longest=2)


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(9_007_199_254_740_993, 9_007_199_254_740_995, 9_007_199_254_740_994), (3, 7, 9), (10**13 - 1, 10**13, 10**13)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r["s"] == 1_000_000 * r["a"] ** 2 // (r["l"] * r["r"]) for r in got)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


# --- 13


def plain_fim(key, text, rate=50, spm=80):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:lo]), "".join(tokens[lo:hi]), "".join(tokens[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("error", [126, 3, 0])
def test_fim_against_a_plain_version(spark, error):
    rnd = random.Random(11)
    texts = ODD + ["<P>a", "a <M> b", "<S>", "< P > <", "P>S><M", *[t for _, t, _ in texts_of(spark)]]
    texts += ["".join(rnd.choice(["a", "🙂", " ", "\n", "<", "S>", "long" * 20, "\x0b", "\x85"]) for _ in range(rnd.randrange(200))) for _ in range(300)]
    rows = [*enumerate(texts), (None, "no id here"), (4, "twice"), (4, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_in_middle.fill_in_middle(docs, rate=90, spm_rate=50, error=error).withColumn("back", fill_in_middle.restore(F.col("output"), F.col("form")))
    got = made.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_fim(r["doc_id"], r["text"], 90, 50)
        assert r["back"] == (r["text"] or "")


def test_segments_keep_to_the_error_and_are_few():
    rnd = np.random.default_rng(1)
    for error in (0, 5, 126):
        offsets = np.concatenate([[0], np.cumsum(rnd.integers(1, 12, 50_000))])
        starts, slopes = fill_in_middle.fit(offsets, error)
        left = offsets - fill_in_middle.predict(np.arange(len(offsets)), starts, offsets[starts], slopes)
        assert np.abs(left).max() <= error + 1
    assert len(starts) < 200
    even = np.arange(0, 700_000, 7)
    assert len(fill_in_middle.fit(even, 0)[0]) == 1


def test_fim_of_a_very_long_text_and_of_jumps(spark):
    rnd = random.Random(2)
    text = " ".join("w" * (rnd.randrange(40_000) if rnd.random() < 0.001 else rnd.randrange(1, 9)) for _ in range(200_000))
    docs = spark.createDataFrame([(k, text) for k in range(4)], "doc_id long, text string")
    for r in fill_in_middle.fill_in_middle(docs, rate=100).collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_fim(r["doc_id"], text, 100)


def test_fim_of_empty_tables_and_clashing_names(spark):
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a b c", 7, "f", 1.0)], "doc_id long, text string, n int, FORM string, _index double")
    made = fill_in_middle.fill_in_middle(docs)
    assert made.columns == ["doc_id", "text", "n", "FORM", "_index", "n_", "form_", "prefix_chars", "middle_chars", "output"]
    row = made.first()
    assert row["n"] == 7 and row["n_"] == 3 and row["_index"] == 1.0
