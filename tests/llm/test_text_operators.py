"""Corpus operators on small, awkward inputs against plain versions."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm import brute
from pyspark.sql import functions as F

from shelfwise.llm import (
    byte_bpe,
    exact_dedup,
    language,
    line_templates,
    minhash,
    mixing,
    queries,
    secrets,
    sharding,
)
from shelfwise.llm.tables import filed

# Extra columns carry names that the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, row_file string, row_position long, "
    "row string, size string, digest string, slot string, component string, language string, n string"
)
EXTRA = ("x", 0, "x", "x", "x", "x", "x", "x", "x")
SIX = "alpha beta gamma delta epsilon zeta"
EDGE = [
    (1, SIX, "en", "a"),
    (2, "alpha  beta\tgamma delta epsilon zeta", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (None, "a text without an id", "de", None),
    (None, "a text without an id", "de", None),
    (5, SIX, "en", "a"),
    (5, SIX, "en", "a"),
    (6, "mot " * 60000 + "fin", "fr", "c"),
    (7, " \n\t ", "es", "c"),
    (8, "...!!! 123", "en", "ä"),
    (9, "Ünïcode ß 語 words \U0001f600 tail", "de", "Z"),
]


@pytest.fixture(scope="module")
def make(spark):
    return lambda rows: spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sized(rows):
    return [(i, source, len(brute.words(text))) for i, text, _, source in rows]


def test_mix_edges(make):
    result = mixing.mix(make(EDGE), block_words=16)
    got = mixing.taken_words(result).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    rows = sized(EDGE)
    totals = Counter()
    for _, source, size in rows:
        totals[source] += size
    target = brute.targets(totals)
    assert sorted([(r.doc_id, r.source, r.size) for r in got], key=repr) == sorted(rows, key=repr)
    taken = Counter()
    for r in got:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - target[source]) <= 0.5
    pieces = result.pieces.select("slot", "source_no", "row", "epoch", "n_words").collect()
    by_slot = Counter()
    for p in pieces:
        by_slot[p.slot, p.source_no] += p.n_words
    assert max(by_slot.values()) <= 16


def test_mix_taken_words(make):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randrange(0, 40), "en", draw.choice(["a", "b", "c", "é", None])) for i in range(120)]
    got = {r.doc_id: r.taken for r in mixing.taken_words(mixing.mix(make(rows), block_words=7)).collect()}
    assert [got[r[0]] for r in rows] == brute.taken(sized(rows))


def test_slots_follow_the_targets(spark):
    point = spark.range(2000).select(mixing.golden(F.col("id")).alias("p")).collect()
    assert [r.p for r in point] == [i * mixing._STEP % (1 << 62) for i in range(2000)]


def test_exact_edges(make):
    got = exact_dedup.exact_duplicates(make(EDGE)).collect()
    groups = defaultdict(list)
    for i, text, *_ in EDGE:
        groups[brute.normal(text)].append(i)
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, min(known) if known else None, len(ids), digest) for i in ids]
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.digest) for r in got], key=repr) == sorted(expected, key=repr)
    # One row of each group stays, and it has the smallest id.
    stays = Counter(r.digest for r in got if r.kept)
    assert set(stays.values()) == {1} and len(stays) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_compares_bytes_when_digests_collide(make):
    rows = [(i, t, "en", "a") for i, t in enumerate(["x", "y", "x", "z", "y", "y", None, ""])]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in
           exact_dedup.exact_duplicates(make(rows), digest=lambda t: F.lit("same")).collect()}
    assert got == {
        0: (0, 2, True), 2: (0, 2, False), 1: (1, 3, True), 4: (1, 3, False), 5: (1, 3, False),
        3: (3, 1, True), 6: (6, 2, True), 7: (6, 2, False),
    }


def test_state_takes_new_files(spark, make, tmp_path):
    from shelfwise.functions.staging import new_path

    folder, checkpoint = new_path(spark, "prints"), new_path(spark, "state")
    schema = "doc_id long, no_id boolean, row_file string, row_position long, digest string"
    first = spark.createDataFrame([(4, False, "f", 0, "a"), (7, False, "f", 1, "b")], schema)
    first.write.parquet(folder)
    exact_dedup.update_state(spark, folder, first.schema, checkpoint)
    spark.createDataFrame([(2, False, "g", 0, "a"), (9, False, "g", 1, "a")], schema).write.mode("append").parquet(folder)
    state = exact_dedup.update_state(spark, folder, first.schema, checkpoint)
    assert {(r.digest, r.keep.doc_id, r.n) for r in state.collect()} == {("a", 2, 3), ("b", 7, 1)}


def test_shards(spark, make):
    records = make(EDGE * 20).select("doc_id", "text", "slot", F.octet_length("text").alias("size"))
    got = sharding.external_shuffle(records, shards=5, bucket_bytes=400_000).collect()
    assert Counter((r.doc_id, r.text, r._slot) for r in got) == Counter((r[0], r[1], "x") for r in EDGE * 20)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(5)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_shuffled_and_repeatable(spark):
    from shelfwise.functions.staging import stage

    records = stage(spark.range(4000).select("id", F.lit(100).alias("size")))
    order = lambda: [r.id for r in sharding.external_shuffle(records, 4, bucket_bytes=100_000).orderBy("shard", "slot").collect()]
    first = order()
    assert first == order() and sorted(first) == list(range(4000))
    steps = np.abs(np.diff(first))
    assert abs(np.mean(steps) - 4000 / 3) < 150 and abs(np.corrcoef(first, range(4000))[0, 1]) < 0.1


def test_shards_hold_the_texts(spark, make, tmp_path, monkeypatch):
    rows = EDGE + [(20 + i, f"text {i} " * 500, "en", "a") for i in range(40)]
    make(rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    write, paths = sharding.write_shards, []

    def harmed(shuffled, path):
        paths.append(path)
        write(shuffled.withColumn("text", F.when(F.col("doc_id") != 20, F.col("text")).otherwise("lost")), path)

    monkeypatch.setattr(sharding, "write_shards", harmed)
    got = queries.shard_documents(spark, str(tmp_path)).collect()
    texts = [(i, "lost" if i in (None, 20) else t) for i, t, *_ in rows]
    crc = lambda t: None if t is None else zlib.crc32(t.encode())
    expected = Counter((i, len((t or "").encode()) + 8, crc(t)) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    # One folder per shard, and its slots have no gap.
    assert sorted(os.listdir(paths[0].removeprefix("file:")))[-1].startswith("shard=")
    for shard in {r.shard for r in got}:
        part = spark.read.parquet(f"{paths[0]}/shard={shard}").select("slot", "text").collect()
        assert sorted(r.slot for r in part) == list(range(len(part)))


def plain_secrets(text):
    """Base spans by the rules as they are written."""
    text, spans = text or "", []
    kinds = [
        (r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    for kind, (pattern, good) in enumerate(kinds):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    return sorted(spans)


def test_secrets(make):
    key = "AKIA" + "ABCD1234" * 2
    random_value = "Zk9vQ2xP7mTr4sWb8nYd"
    texts = [
        None, "", "password: hunter22", "PassWord='abc", "secret=token:abcdef and token = x_key.12345",
        f"é\U0001f600 {key} {key}Z9 AKIAshort", "0123456789abcdef01234567 and deadbeef", "api_key==abcdefgh",
        "ſecret: abcdefgh", "to\u212aen: abcdefgh", f"loose {random_value} end", f"copied {random_value[::-1]} text",
        f"copied {random_value[::-1]} text", f"copied {random_value[::-1]} text", "secret " * 20000 + "token:last1234",
        f"token={random_value}", "a" * 300_000,
    ]
    draw = random.Random(5)
    alphabet = ["password", "token", "Secret", "API_KEY", "=", ":", " ", "'", '"', "abc", "-", "0f" * 13, key, "\n", "é"]
    texts += ["".join(draw.choices(alphabet, k=12)) for _ in range(300)]
    docs = make([(i, t, "en", f"s{i}") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = plain_secrets(text)
        listed = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), text
        count = Counter(k for _, k, _ in base)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (count[0], count[1], count[2])
        assert set(listed.split(",")) - {""} <= set(got[i].spans.split(","))
    # A loose value of one owner is a span, one that three owners hold is not.
    assert got[10].spans == "owned:6:26" and got[10].n_live == 1
    assert got[11].spans == "" and got[12].spans == ""


def test_secret_ownership(make):
    rows = [(i, "token=Abc123xyz9", "en", f"s{i % 4}") for i in range(8)] + [(9, "token=Qrs456tuv0", "en", "s1")]
    got = {r.doc_id: (r.n_live, r.n_examples) for r in secrets.scan_secrets(make(rows)).collect()}
    assert got[0] == (0, 1) and got[9] == (1, 0)


def test_secret_copied_inside_one_source(make):
    wide, own, two = "Zk9vQ2xP7mTr4sWb8nYd", "Hq7cV1zL5kNs3tXa6mUe", "Rb4jF8wE2yGd9pQo0iKh"
    rows = [(i, f"use {wide} here", "en", "hot") for i in range(12)]
    rows += [(20 + i, f"{own} and token=Abc123xyz9", "en", "hot") for i in range(3)]
    rows += [(40 + i, f"use {two} here", "en", f"s{i % 2}") for i in range(24)]
    got = {r.doc_id: (r.spans, r.n_live, r.n_examples, r.holders) for r in secrets.scan_secrets(make(rows)).collect()}
    assert all(got[i] == ("", 0, 0, "") for i in [*range(12), *range(40, 64)])
    assert got[20] == ("owned:0:20,assign:25:41", 2, 0, "3:1,3:1")
    many = [(i, "token=Abc123xyz9", "en", "hot") for i in range(15)]
    assert {(r.n_live, r.n_examples, r.holders) for r in secrets.scan_secrets(make(many)).collect()} == {(0, 1, "15:1")}


SAMPLES = {
    "en": "the and of that with from which this have there were",
    "de": "der und die das nicht mit auch auf für eine werden",
    "fr": "les des une dans pour que qui avec être cette aux",
}


def test_language(make):
    draw = random.Random(1)
    rows = [
        (i, " ".join(draw.choices(SAMPLES[lang].split(), k=30)), lang, "a")
        for i, lang in enumerate(draw.choices(list(SAMPLES), k=150))
    ]
    rows += [(200, None, "en", "a"), (201, "", "de", "a"), (202, "123 ...", None, "a"), (None, "the and of", "de", "a"),
             (204, "und nicht " * 100_000, None, "a"), (205, "the and of", None, "a")]
    got = {r.doc_id: r for r in language.identify(make(rows), per_language=40).collect()}
    assert len(got) == len(rows)
    for i, text, lang, _ in rows:
        row = got[i]
        assert row.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        if not text or not any(map(str.isalpha, text)):
            assert (row.lang_pred, row.score) == ("und", 0)
        elif i is not None and i < 200:
            assert row.lang_pred == lang
    assert got[204].lang_pred == "de" and got[205].lang_pred == "en"
    # Labels of held-out documents play no part.
    moved = [(i, t, "fr" if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else g, s) for i, t, g, s in rows]
    again = {r.doc_id: r for r in language.identify(make(moved), per_language=40).collect()}
    assert all(again[i].lang_pred == got[i].lang_pred and again[i].score == pytest.approx(got[i].score) for i in got)


def test_language_with_empty_and_equal_rows(make):
    draw = random.Random(6)
    texts = [(" ".join(draw.choices(SAMPLES[lang].split(), k=12)), lang) for lang in SAMPLES for _ in range(90)]
    # A third of the rows are null or empty, a sixth copies of a short word.
    texts += [(None if i % 2 else "", lang) for lang in SAMPLES for i in range(60)]
    texts += [("x", lang) for lang in SAMPLES for _ in range(30)]
    rows = [(i, t, lang, "a") for i, (t, lang) in enumerate(texts)]
    docs = make(rows)
    sample = language.training_rows(filed(docs), "doc_id", "text", "lang", 600, 4000).collect()
    assert all(any(r.bins) for r in sample) and len({(r.lang, r.bins) for r in sample}) == len(sample)
    got = {r.doc_id: r for r in language.identify(docs, landmarks=24).collect()}
    for i, text, lang, _ in rows[:270]:
        assert got[i].lang_pred == lang and got[i].score > 0.3, text


def test_landmarks_follow_the_draw(make, monkeypatch):
    # Short texts of letters with low bins would come first in the order of the bytes.
    draw = random.Random(7)
    rows = [(i, "".join(draw.choices("abcdefghij", k=1 + i % 40)), "en" if i % 2 else "de", "a") for i in range(200)]
    kernels, kernel = [], language._kernel
    monkeypatch.setattr(language, "_kernel", lambda a, b: kernels.append((a, b)) or kernel(a, b))
    language.fit(make(rows), landmarks=20)
    marks = np.unpackbits(kernels[0][0], axis=1).sum(1)
    everything = np.unpackbits(kernels[1][0], axis=1).sum(1)
    assert len(marks) == 20 and marks.mean() > 0.6 * everything.mean()


def test_language_without_labels(make):
    got = language.identify(make([(1, "some text", None, "a")])).collect()
    assert (got[0].lang_pred, got[0].score) == ("und", 0)


FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@needs_tables
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) > 0


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def official(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash(ranks):
    table = byte_bpe.perfect_hash(ranks)
    assert len(table.keys) == len(ranks)
    assert all(table.rank(token) == rank for token, rank in ranks.items())
    assert table.rank(b"no such token at all") == -1 and table.rank(b"") == -1


def test_encoding_equals_the_library(ranks, official):
    encoder = byte_bpe.Encoder(byte_bpe.perfect_hash(ranks), public_tokenizers.PATTERN)
    draw = random.Random(2)
    parts = [" ", "  ", "\n", "\t", " a", "it's", "'ll", "9", "é", "?!", "\U0001f600", "\x1c", "\x85", "\u3000", "zqx", "the"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(1, 25))) for _ in range(5000)]
    texts += ["", "a" * 5000, " " * 300, "<|endoftext|>", "".join(chr(draw.randrange(1, 0x2FFF)) for _ in range(3000))]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == official.encode_ordinary(text)


def test_a_text_is_split_once_and_a_pretoken_encoded_once(ranks, official):
    encoder = byte_bpe.Encoder(byte_bpe.perfect_hash(ranks), public_tokenizers.PATTERN)
    text = " ".join(f"{word}{end}" for word in ("zqxj", "the", "athawh", "oftionnten") for end in ("", ",", ".", "?!", "'s"))
    split, rank, calls = encoder.split, encoder.rank, Counter()

    def counted(name, call):
        return lambda value: calls.update([name]) or call(value)

    encoder.split, encoder.rank = counted("split", split), counted("rank", rank)
    for _ in range(3):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == official.encode_ordinary(text)
    assert calls == {"split": 3, "rank": len(set(split(text)))}


def test_pretokens_may_hold_single_spaces(ranks):
    pattern = r"\p{L}+ \p{L}+|\s|[^\s]"
    library = tiktoken.Encoding("pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(byte_bpe.perfect_hash(ranks), pattern)
    for text in ("of the zqxj athawh end", "one two, three four\nfive six", "a b"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_edges(make, ranks, official):
    got = byte_bpe.token_digests(make(EDGE), ranks, public_tokenizers.PATTERN).collect()
    expected = []
    for i, text, *_ in EDGE:
        ids = official.encode_ordinary(text or "")
        expected.append((
            i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ))
    assert rows_of(byte_bpe.token_digests(make(EDGE).limit(0), ranks, public_tokenizers.PATTERN)) == []
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def near_rows():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(12):
        words = draw.choices(vocabulary, k=draw.randrange(5, 120))
        rows.append(" ".join(words))
        for _ in range(draw.randrange(0, 5)):
            words = list(words)
            for _ in range(draw.randrange(0, 3)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary).upper()
            rows.append(draw.choice([" ", "\n", "  "]).join(words))
    draw.shuffle(rows)
    return [(i, t, "en", "a") for i, t in enumerate(rows)]


def test_minhash(make):
    rows = near_rows() + [(100 + k, t, la, s) for k, (_, t, la, s) in enumerate(EDGE)]
    rows += [(300, "one two three", "en", "a"), (301, "ONE two three", "en", "a"), (302, "one two", "en", "a")]
    sets, component = brute.near_groups([r[1] for r in rows], 4)
    got = {r.doc_id: r for r in minhash.near_duplicates(make(rows), shingle_words=4).collect()}
    least = {}
    for r, c in zip(rows, component, strict=True):
        least[c] = min(r[0], least.get(c, r[0]))
    for r, s, c in zip(rows, sets, component, strict=True):
        assert (got[r[0]].n_shingles, got[r[0]].component_id, got[r[0]].kept) == (len(s), least[c], r[0] == least[c])


def test_minhash_repeated_ids(make):
    got = minhash.near_duplicates(make(EDGE), shingle_words=4).collect()
    assert len(got) == len(EDGE)
    # One row stays per group, rows without shingles each.
    assert sum(r.stays for r in got) == len({tuple(sorted(brute.shingles(t, 4))) for _, t, *_ in EDGE if brute.words(t)}) + sum(
        not brute.words(t) for _, t, *_ in EDGE
    )
    assert {r.component_id for r in got if r.doc_id in (1, 2, 5)} == {1}


def test_minhash_hot_group(spark, make):
    base = [f"t{i}" for i in range(80)]
    rows = [(i, " ".join([*base[: i % 80], f"x{i}", *base[i % 80 + 1 :]]), "en", "a") for i in range(400)]
    _, component = brute.near_groups([r[1] for r in rows], 5)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(make(rows)).collect()}
    assert [got[i] for i in range(400)] == component


def test_estimate_follows_similarity(spark):
    memo, (factors, terms) = minhash.WordHashes(), minhash._permutations()
    base = [f"w{i}" for i in range(400)]
    rows, expected = [], []
    for changed in (0, 2, 5, 10, 40):
        other = [f"y{i}" if i < changed * 4 and i % 4 == 0 else w for i, w in enumerate(base)]
        a, b = (minhash.shingle_set(" ".join(w), 5, memo) for w in (base, other))
        both = len(np.intersect1d(a, b))
        expected.append(both / (len(a) + len(b) - both))
        rows.append(tuple(minhash.low_bits(minhash.minima(s, factors, terms)).tolist() for s in (a, b)))
    got = spark.createDataFrame(rows, "a array<long>, b array<long>").select(minhash.estimate("a", "b").alias("e")).collect()
    for r, s in zip(got, expected, strict=True):
        assert abs(r.e - s) < 0.2
    assert got[0].e == 1


def test_line_templates(make):
    shared = "Copyright 2024 by Example Corp all rights reserved"
    rows = []
    for i in range(12):
        lines = [f"own line number of text {chr(97 + i)} with words", f"Copyright {2000 + i} by Example Corp all rights reserved"]
        lines += ["short one", "short one", "Click here to read more about it today"] if i % 3 else ["Click here to read less of it today"]
        rows.append((i, "\n".join(lines), "en", "a"))
    rows += [(20, shared, "en", "a"), (21, None, "en", "a"), (22, "", "en", "a"), (None, f"kept line with words\n{shared}\n", "en", "a"),
             (23, "\n\n" + "x" * 200_000 + " 1 2 3\n" + "a b c " * 30_000, "en", "a"), (24, shared + "\n" + shared, "en", "a")]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(make(rows)).collect()}
    expected = brute.recurring_lines([r[1] for r in rows])
    assert any(expected)
    for (i, text, *_), gone in zip(rows, expected, strict=True):
        assert got[i].dropped_lines == gone, text
        kept = None if text is None else "\n".join(x for no, x in enumerate(text.split("\n")) if no not in gone)
        assert got[i].text == kept
    templates = line_templates.recurring_templates(make(rows))
    assert ("Copyright <*> by Example Corp all rights reserved", 15) in {tuple(r) for r in templates.collect()}


def dropped(make, lines):
    """Numbers of the dropped lines of documents of one text each, checked by brute force."""
    got = {r.doc_id: r.dropped_lines for r in line_templates.drop_recurring_lines(make([(i, t, "en", "a") for i, t in enumerate(lines)])).collect()}
    assert [got[i] for i in range(len(lines))] == brute.recurring_lines(lines)
    return [got[i] for i in range(len(lines))]


def test_line_fields_beside_foreign_lines(make):
    names = [f"name{'x' * i} of{'y' * i}" for i in range(20)]
    posts = [f"Posted in the forum by {n} under the general terms of use and with all rights" for n in names]
    foreign = ["Posted in the spring of that year by a friend whom we had not seen since"]
    assert len(foreign[0].split()) == len(posts[0].split()) - 1
    foreign.append(foreign[0] + " then")
    assert dropped(make, posts + foreign) == [[0]] * 20 + [[], []]
    templates = {r.template: r.n_documents for r in line_templates.recurring_templates(make([(i, t, "en", "a") for i, t in enumerate(posts)])).collect()}
    assert templates["Posted in the forum by <*> the general terms of use and with all rights"] == 20


def test_line_leads_prove_nothing(make):
    nouns = [f"thing{'s' * i}" for i in range(12)]
    assert dropped(make, [f"This is a {n}" for n in nouns]) == [[]] * 12
    assert dropped(make, [f"This is a {n} and {n} is not {n}" for n in nouns]) == [[]] * 12


def test_short_and_long_lines_recur(make):
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    texts = ["Read more\nown a", *["Read more"] * 7, f"12 7\n{long}", f"{long}\n{long}\nrest", *["12 7\n\n3"] * 9, "Read  more\nx"]
    gone = dropped(make, texts)
    assert gone[0] == [0] and gone[7] == [0] and gone[-1] == [0]
    assert gone[8] == [] and gone[9] == [0, 1] and gone[10:19] == [[]] * 9


def test_many_tokens_in_one_line(make):
    line = " ".join(["alpha", "beta", "gamma", *[f"w{chr(97 + i % 26)}" for i in range(20_000)]])
    changed = [line.replace(" wb wc", f" {'q' * (i + 1)} wc", 1) for i in range(9)]
    assert dropped(make, [*changed, line + " 1", None, ""]) == [[0]] * 9 + [[], [], []]


def test_empty_tables(make, ranks):
    none = make(EDGE).limit(0)
    assert rows_of(mixing.taken_words(mixing.mix(none))) == []
    assert rows_of(exact_dedup.exact_duplicates(none)) == []
    assert rows_of(sharding.external_shuffle(none.select("doc_id", F.length("text").alias("size")))) == []
    assert rows_of(secrets.scan_secrets(none)) == []
    assert rows_of(language.identify(none)) == []
    assert rows_of(minhash.near_duplicates(none)) == []
    assert rows_of(line_templates.drop_recurring_lines(none)) == []


def test_bpe_keeps_clashing_columns(spark, ranks):
    rows = [("one text", "a", "b", "c", "d", "e")]
    docs = spark.createDataFrame(rows, "text string, coded string, bpe__ string, _coded string, IDS string, Decoded string")
    got = byte_bpe.tokenize(docs, ranks, public_tokenizers.PATTERN)
    assert got.columns == ["text", "coded", "bpe__", "_coded", "ids", "decoded"]
    row = got.first()
    assert row[:4] == ("one text", "a", "b", "c") and bytes(row.decoded) == b"one text"


def test_shards_keep_clashing_columns(spark):
    rows = [(i, 10, "a", "b", "c") for i in range(6)]
    docs = spark.createDataFrame(rows, "id long, size int, shard string, _shard string, SLOT string")
    got = sharding.external_shuffle(docs, shards=2)
    assert got.columns == ["id", "size", "__shard", "_shard", "_SLOT", "shard", "slot"]
    assert {(r["__shard"], r["_shard"], r["_SLOT"]) for r in got.collect()} == {("a", "b", "c")}


def test_lines_keep_clashing_columns(spark):
    rows = [("one line that all of them hold", "a", "b", "c", "d", "e") for _ in range(9)]
    docs = spark.createDataFrame(
        rows, "text string, gone__ string, gone string, gone_file string, Dropped_Lines string, gone_position string"
    )
    got = line_templates.drop_recurring_lines(docs)
    assert got.columns == ["text", "gone__", "gone", "gone_file", "gone_position", "dropped_lines"]
    assert {tuple(r[:5]) for r in got.collect()} == {("", "a", "b", "c", "e")}


def test_ids_are_handed_on_in_slices_and_a_small_memo_changes_nothing(make, monkeypatch):
    rows = [(i, f"word{i % 7} and  some {'x' * (i % 5)} more", "en", "s") for i in range(60)] + [(60, None, "en", "s")]
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = {tuple(r) for r in byte_bpe.token_digests(make(rows), ranks, public_tokenizers.PATTERN).collect()}
    monkeypatch.setattr(byte_bpe, "SLICE_CHARS", 50)
    found = byte_bpe.token_digests(make(rows), ranks, public_tokenizers.PATTERN, memo=3).collect()
    assert len(found) == 61 and {tuple(r) for r in found} == whole
