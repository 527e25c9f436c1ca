"""Vectors, URLs and the pipeline on small inputs against plain versions."""

import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm import brute

import corpus_pipeline
from shelfwise.llm import byte_bpe, near_vectors, url_filter

FOLDER = "/root/testdata/sf0.001"


def vector_rows():
    random = np.random.default_rng(6)
    rows = []
    for label in (1, 2):
        centre = random.standard_normal(16)
        for scale in (0.02, 0.05, 0.1, 0.15, 0.2):
            rows += [((centre + scale * random.standard_normal(16)).tolist(), label) for _ in range(12)]
        rows += [(random.standard_normal(16).tolist(), label) for _ in range(20)]
    rows += [rows[0], rows[0], (rows[0][0], 2), ([2 * x for x in rows[0][0]], 1), (rows[0][0], None), (None, 1), ([], 1),
             ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([float("inf")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1),
             ([1.0, 2.0], 1), ([1.0, 2.0], 1), ([1e200] + [0.0] * 15, 2), ([1e199] + [0.0] * 15, 2)]
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


def plain_links(rows, least=0.98):
    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [None if label is None or not sound(v) else np.array(v) / np.abs(v).max() for _, v, label in rows]
    pairs = []
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                pairs.append((i, j))
    return pairs


def test_near_vectors(spark, monkeypatch):
    rows = vector_rows()
    pairs = plain_links(rows)
    component = brute.components(len(rows), pairs)
    n = Counter(x for p in pairs for x in p)
    # Small blocks, so that buckets are compared block by block.
    monkeypatch.setattr(near_vectors, "BLOCK", 8)
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, rep string, links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(table).collect()}
    assert got == {i: (n[i], component[i], component[i] == i) for i in range(len(rows))}
    assert near_vectors.near_vectors(table.limit(0)).collect() == []


def test_near_vectors_without_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.001], 1), (3, [0.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, near_vectors.near_vectors(table).collect()), key=repr)
    assert got == sorted([(None, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (3, 0, 3, True)], key=repr)


def test_codes_bound_the_product():
    random = np.random.default_rng(1)
    dim = 64
    a = random.standard_normal((300, dim))
    b = a + random.uniform(0, 1.5, (300, 1)) * random.standard_normal((300, dim))
    _, bits, factors = near_vectors.encode(b)
    turned = near_vectors.unit(a) @ near_vectors.rotations(dim)[:, :dim]
    estimate = (turned * np.where(bits, 1, -1)).sum(1) / (np.sqrt(dim) * factors)
    exact = (near_vectors.unit(a) * near_vectors.unit(b)).sum(1)
    bound = near_vectors.DEVIATIONS * np.sqrt(1 - factors**2) / factors / np.sqrt(dim - 1)
    assert (np.abs(estimate - exact) <= bound).all() and abs((estimate - exact).mean()) < 0.02


def plain_judgement(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule in url_filter.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.host + rule.path) > len(best.host + best.path):
                best = rule
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url)

    def count(term):
        at = [i for i in range(len(low)) if low.startswith(term, i)]
        ok = lambda i: not (0 <= i < len(low)) or not (low[i].isascii() and low[i].isalnum())
        return sum(ok(i - 1) and ok(i + len(term)) for i in at)

    strict = sum(map(count, url_filter.STRICT))
    soft = sum(count(t) > 0 for t in url_filter.SOFT)
    verdict = best.verdict if best else "block" if strict or soft >= url_filter.SOFT_LIMIT else "allow"
    return host, path, best and best.host + best.path, verdict, strict, soft


def test_url_filter(spark):
    urls = [
        None, "", "no scheme/at/all", "http://", "http://net", "http://net/", "http://a.NET/x", "http://xnet/x",
        "https://www.Example.net/en/1?q#f", "https://example.net/en", "http://example.com/de/", "http://a.b.example.com/de/x?y",
        "http://example.com/fr/", "http://a.org/fr/", "http://a.org/FR/", "http://x.net?casino", "ftp://y.com/casino-online",
        "http://y.com/casinos", "http://y.com/free-bet", "http://y.com/free/free", "http://y.com/freebet", "://net/",
        "http://a://net/", "http://y.com/FREE?WIN", "http://cheap-pills.com/", "http://é.com/ébet/loan", "http://y.com/" + "bet" * 100_000,
    ]
    table = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string, terms string")
    got = url_filter.judge_urls(table).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        assert tuple(r)[1:] == plain_judgement(urls[r.page_id]), urls[r.page_id]
    assert url_filter.judge_urls(table.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline_equals_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text", "source").collect())
    rows = [r for r in rows if r.text and any(map(str.isalpha, r.text))]
    seen, unique = set(), []
    for r in rows:
        if brute.normal(r.text) not in seen:
            seen.add(brute.normal(r.text))
            unique.append(r)
    _, component = brute.near_groups([r.text for r in unique], 5)
    kept = [r for i, r in enumerate(unique) if component[i] == i]
    sizes = [(r.doc_id, r.source, len(brute.words(r.text))) for r in kept]
    taken = brute.taken(sizes)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    official = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for r, (_, _, size), words in zip(kept, sizes, taken, strict=True):
        ids = np.array(official.encode_ordinary(r.text), "<u4")
        row = (r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
        # A copy per epoch that the mix takes words of.
        expected[row] += -(-words // size)
    got = Counter(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert +expected == got


def test_stages_keep_columns_and_take_awkward_rows(spark):
    from shelfwise.functions.staging import stage

    rows = [(1, "the text of one", "en", "a", "x"), (1, "the text of one", "en", "a", "x"), (None, None, None, None, None),
            (2, "", "en", None, None), (None, "a text without id", "en", None, "y"), (3, "12 34", "en", "b", "z")]
    docs = stage(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row_file string"))
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, FOLDER))
        assert docs.columns == ["doc_id", "text", "lang", "source", "row_file"]
    # Each of the two texts is taken whole and half again at most.
    assert set(docs.select("text").collect()) <= {("the text of one",), ("a text without id",)}
    empty = stage(docs.limit(0))
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, empty, FOLDER).collect() == []


def test_unlabelled_corpus_keeps_its_documents(spark):
    from shelfwise.functions.staging import stage

    schema = "doc_id long, text string, lang string, source string"
    texts = ["the text of one", "ein Text", "12 34", "", None, "語"]
    unlabelled = [(i, t, None, "x") for i, t in enumerate(texts)]
    no_ids = [(None, t, "en", "x") for t in texts]
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2)
    held_out = [(held, t, "en", "x") for t in texts]
    for rows in (unlabelled, no_ids, held_out):
        docs = stage(spark.createDataFrame(rows, schema))
        kept = corpus_pipeline.keep_languages(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        assert {r.text for r in kept.collect()} == {"the text of one", "ein Text", "語"}


def test_unlabelled_corpus_through_the_pipeline(spark, tmp_path):
    texts = ["the text of one document", "ein anderer Text", "12 34", "", None]
    rows = [(i, t, None, "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {0, 1}
