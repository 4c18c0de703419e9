"""The registered queries on the whole smallest tables, against brute force; and the pipeline."""

import base64
import collections
import struct
import zlib

import duckdb
import llm_brute as brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard

import __spark_entry__ as entry
import corpus_pipeline
from debutrank.llm import line_chunks, quality
from debutrank.llm.queries import R
from test_llm_operators import chunks_by_hand, poured
from tools.check import TABLES, compare


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    return [(r.doc_id, r.text) for r in rows], {r.doc_id: r.source for r in rows}


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]


def result(spark, sf_dir, name, *columns):
    df = entry.queries()[name](spark, sf_dir)
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_all_are_registered():
    names = set(entry.queries())
    assert set(R.queries) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in R.queries) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(R.sql))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    message, _ = compare(spark, con, name, sf_dir, entry.queries()[name], R.sql[name])
    assert message.startswith("ok") and "TYPES" not in message, message


def test_op1(spark, sf_dir, raw):
    got = result(spark, sf_dir, "op1_log_frequency_bloom")
    for a, b in zip(got, sorted(brute.base_scores(raw[0]))):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(r[6] <= 0 for r in got)


def test_op2(spark, sf_dir, raw):
    docs, sources = raw
    got = result(spark, sf_dir, "op2_entropy_mix", "doc_id", "size", "source_size", "target", "taken")
    assert [r[:2] for r in got] == [(k, len(brute.WORD.findall(t))) for k, t in docs]
    by, taken = collections.Counter(), collections.Counter()
    for k, size, _, _, words in got:
        by[sources[k]] += size
        taken[sources[k]] += words
        assert words <= 2 * size
    want = poured(by)
    for k, _, source_size, target, _ in got:
        assert source_size == by[sources[k]] and target == pytest.approx(want[sources[k]])
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] for s in by)


def test_op3(spark, sf_dir, raw):
    got = result(spark, sf_dir, "op3_byte_shards")
    sizes = [len(t.encode()) + 1 for _, t in raw[0]]
    total, before, slots = sum(sizes), 0, collections.Counter()
    for (k, t), size, row in zip(raw[0], sizes, got):
        shard = min((2 * before + size) * 8 // (2 * total), 7)
        assert row == (k, size, zlib.crc32(t.encode()), "bytes", shard, slots[shard], None)
        slots[shard] += 1
        before += size


def test_op4(spark, sf_dir, raw):
    assert result(spark, sf_dir, "op4_suffix_automata") == sorted(brute.word_windows(raw[0]))


def test_op5(spark, sf_dir, raw):
    assert result(spark, sf_dir, "op5_tensored_minhash") == sorted(brute.groups(raw[0]))


def test_op6(spark, sf_dir, raw):
    texts = dict(raw[0])
    got = result(spark, sf_dir, "op6_surrogates", "doc_id", "text", "n_entities")
    assert [r[0] for r in got] == sorted(texts)
    for k, text, n in got:
        assert (text == texts[k]) == (n == 0)
        assert n > 0 or "@" not in text
    assert sum(n > 0 for _, _, n in got) > 5


def verdict(text):
    packer = zstandard.ZstdCompressor(level=3, write_content_size=False)
    data = (text or "").encode()
    ratio = len(packer.compress(data)) / len(data) if data else 1
    band = [b for b in quality.BANDS if b.from_bytes <= len(data)][-1]
    size = quality.CHUNK_BYTES
    starts = [min(i, len(data) - size) for i in range(0, len(data), size)] if len(data) >= size else []
    parts = [data[i : i + size] for i in starts]  # the last one ends with the text
    low, high = quality.CHUNK_BAND[1:]
    outside = sum(not low <= len(packer.compress(p)) / size <= high for p in parts)
    return band.low <= ratio <= band.high and outside <= quality.CHUNK_SHARE * len(parts)


def kept(text):
    return not brute.counts(text)[-1] and verdict(text)


def test_op7(spark, sf_dir, raw):
    columns = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    got = result(spark, sf_dir, "op7_compression_bands", *columns)
    assert got == [(k, *brute.counts(t), kept(t)) for k, t in raw[0]]


def test_op8(spark, sf_dir, raw):
    want = [(k, n, r, brute.sha(t.encode())) for k, n, r, t in chunks_by_hand(raw[0])]
    assert result(spark, sf_dir, "op8_line_chunks") == sorted(want)
    assert line_chunks.LEAST_LINES == 2


def test_op9(spark, sf_dir, raw):
    assert result(spark, sf_dir, "op9_difference_cover") == sorted(brute.byte_windows(raw[0]))


def test_op12(spark, sf_dir, raw):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    want = []
    for k, t in raw[0]:
        ids = library.encode_ordinary(t or "")
        want.append((k, len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha((t or "").encode())))
    assert result(spark, sf_dir, "op12_scanned_byte_bpe") == want


def test_op13(spark, sf_dir, raw):
    got = result(spark, sf_dir, "op13_dyadic_squares")
    assert got == brute.periods(raw[0])
    assert sum(r[1] > 0 for r in got) > 5


def test_op11(spark, sf_dir, raw):
    got = result(spark, sf_dir, "op11_variable_grams", "word", "form", "root", "n", "n_near", "form_n")
    assert sorted(got, key=repr) == sorted(brute.variants(raw[0]), key=repr)
    assert sum(r[1] is not None for r in got) > 0


def test_pipeline(spark, sf_dir, raw, items):
    docs, sources = raw
    stay = [(k, t) for k, t in docs if kept(t)]
    stay = [d for d, g in zip(stay, brute.groups(stay)) if g[3]]
    stay = [d for d, h in zip(stay, brute.hits(stay, items)) if not h[2]]
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert list(got.columns) == [*columns, "size", "shard", "slot"]
    assert set(got.doc_id) <= {k for k, _ in stay}
    # every document that stays is taken up to twice, and the words of a source come near its target
    copies = collections.Counter(got.doc_id)
    assert max(copies.values()) <= 2
    words = {k: len(brute.WORD.findall(t)) for k, t in stay}
    by, taken, longest = collections.Counter(), collections.Counter(), collections.Counter()
    for k, n in words.items():
        by[sources[k]] += n
        taken[sources[k]] += n * copies[k]
        longest[sources[k]] = max(longest[sources[k]], n)
    for s, target in poured(by).items():
        assert abs(taken[s] - target) <= max(0.05 * target, longest[s] / 2)
    texts = dict(docs)
    assert all(texts[k] == t for k, t in zip(got.doc_id, got.text))
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 2 * got["size"].max()
    for _, mine in got.groupby("shard"):
        assert sorted(mine.slot) == list(range(len(mine)))
    ordered = got.sort_values(["shard", "slot"]).doc_id.to_numpy()
    assert (np.diff(ordered) >= 0).all()


def test_stages_return_the_columns_of_documents(spark, docs, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules"
    narrow = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, narrow.limit(0), sf_dir).columns == narrow.columns
