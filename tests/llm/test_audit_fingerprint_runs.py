"""Source audit, fingerprints and periodic runs against plain versions."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import regex
import xxhash
from llm import brute
from pyspark.sql import functions as F

from shelfwise.llm import divergence, periodic_runs, syncmers

# Extra columns carry names that the operators use inside.
NAMES = [
    "row_file", "row_position", "digest", "term", "split", "n", "item", "found", "best", "Runs", "COLLAPSED", "starts",
    "head", "rank", "wanted", "prev_file", "at", "piece", "tie", "own", "other", "edited", "no", "block", "value", "top",
]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in NAMES)
EDGE = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (2, None, "en", "b"),
    (3, "", None, None),
    (None, "a text without an id", "de", None),
    (None, "a text without an id", "de", None),
    (5, "repeated row " * 9, "en", "a"),
    (5, "repeated row " * 9, "en", "a"),
    (6, "mot " * 60000 + "fin", "fr", "c"),
    (7, " \n\t ", "es", "c"),
    (8, "...!!! 123", "en", "ä"),
    (9, "Ünïcode ß 語彙文字列長文 words \U0001f600 tail " * 3 + "x" * 5000, "de", "Z"),
]


@pytest.fixture(scope="module")
def make(spark):
    return lambda rows: spark.createDataFrame([(*r, *["x"] * len(NAMES)) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def plain_audit(rows, min_documents, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    documents, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        terms = regex.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang or ""].add(source or "")
        documents[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= min_documents]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        share, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(share[s][t] - q[t], t) for t in kept if counts[lang, s][t] and share[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i) for i, (v, item) in enumerate(found, 1) if part == "pair" or i <= top}
    return out


@pytest.mark.parametrize("bits", [64, 3])
def test_audit(make, bits):
    draw = random.Random(1)
    words = [f"{a}{b}" for a in "abcdéß語" for b in "xyzÄK"]
    rows = [
        (i, " ".join(draw.choices(words, k=draw.randrange(0, 30))) + ", 12-A", draw.choice(["en", "de", None]),
         draw.choice(["a", "b", "B", "é", None]))
        for i in range(150)
    ] + EDGE + [(300, "Only here", "xx", "a"), (301, "or there", "xx", "b")]
    # Three bits make terms share digests.
    same = {} if bits == 64 else {"digest": lambda t: divergence.digest(t) % 8}
    got = divergence.audit_sources(make(rows), min_documents=6, **same)
    assert got.schema.simpleString() == "struct<lang:string,source:string,part:string,item:string,value:bigint,rank:int>"
    assert sorted(map(tuple, got.collect())) == sorted(plain_audit(rows, 6))
    few = divergence.audit_sources(make(rows), min_documents=6, top_terms=2)
    assert sorted(map(tuple, few.collect())) == sorted(plain_audit(rows, 6, 2))


def test_audit_blocks_and_flushes(make, monkeypatch):
    draw = random.Random(2)
    words = [f"{a}{b}{c}" for a in "abcde" for b in "fghij" for c in "klmno"]
    rows = [(i, " ".join(draw.choices(words, k=25)), "en", draw.choice("abcdefg")) for i in range(80)]
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 64)
    monkeypatch.setattr(divergence, "HELD_TERMS", 40)
    got = divergence.audit_sources(make(rows), min_documents=3).collect()
    assert sorted(map(tuple, got)) == sorted(plain_audit(rows, 3))


def test_terms_are_held_once_for_all_sources(make, monkeypatch):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(10)]
    rows = [(i, " ".join(words), "en", f"s{i}") for i in range(30)]
    docs = make(rows).coalesce(1)
    monkeypatch.setattr(divergence, "HELD_TERMS", 100)
    counts = divergence.term_counts(docs, "text", "lang", "source", divergence.digest)
    assert counts.where("kind = 'uses'").count() == 30 * 60
    assert {(r.term, r.n) for r in counts.where("kind = 'terms'").collect()} == {(w, 30) for w in words}
    monkeypatch.setattr(divergence, "HELD_USES", 200)
    again = divergence.term_counts(docs, "text", "lang", "source", divergence.digest).where("kind = 'terms'")
    assert again.count() > 60 and again.groupBy("term").sum("n").where("`sum(n)` <> 30").isEmpty()



def test_shares_are_exact(spark):
    count, total, terms = 3 * 10**15 + 1, 7 * 10**15, 10**7
    row = spark.range(1).select(
        divergence.share(F.lit(count), F.lit(total), F.lit(terms)).alias("p")
    ).first()
    assert row.p == 1 + 10**9 * (count + 5) // (total + 5 * terms)


# --- fingerprints -----------------------------------------------------------------------


def xx(value, seed=42):
    data = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    h = xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    return h - 2**64 if h >= 2**63 else h


def fold(values, seed=42):
    for v in values:
        seed = xx(v, seed)
    return seed


def plain_anchors(text):
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    unspaced = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
    tokens = []
    for w in words:
        if len(text) <= 64:
            tokens += list(w)
        elif len(w.encode()) <= 16:
            tokens.append(w)
        else:
            tokens += regex.findall(f"[{unspaced}]|[^{unspaced}]{{1,8}}", w)
    h1 = [xx(t) for t in tokens]
    h = [fold(p) for p in zip(h1, h1[1:], strict=False)]
    out = []
    for i in range(len(h) - 4):
        window = h[i : i + 5]
        if min(window) in (window[0], window[-1]):
            out.append((i, fold([window[0], window[2], window[4]])))
    if not out and h1:
        out = [(0, fold(h1))]
    return out


def plain_likeness(a, b):
    def shared(x, y):
        return len(x & y) / max(1, len(x | y))

    if not a and not b:
        return 1.0
    return max(shared({h for _, h in a}, {h for _, h in b}), shared(set(a), set(b)))


def plain_written(found):
    out, before = "", 0
    for at, h in found:
        gap = min(at - before, 35)
        out += "0123456789abcdefghijklmnopqrstuvwxyz"[gap] + f"{h & 0xFFFFFFFF:08X}"
        before = at
    return out


def test_fingerprints(make):
    draw = random.Random(3)
    words = [f"word{i}" for i in range(60)] + ["語彙文字", "Straße", "éà", "x" * 40]
    rows = [(100 - i, " ".join(draw.choices(words, k=draw.randrange(0, 60))), "en", "a") for i in range(60)]
    rows += [(200, "語彙文字列長文資料検索" * 9, "ja", "a"), (201, "the same again " * 60, "en", "a")] + EDGE
    # Ascending ids, nulls last; rows that are equal in both are interchangeable here.
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    expected = Counter()
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        own, other = plain_anchors(text), plain_anchors(edited)
        expected[(
            doc_id, len(text), sha(edited), plain_written(own), plain_written(other),
            plain_likeness(own, other), plain_likeness(own, plain_anchors(following)),
        )] += 1
    got = syncmers.edited_fingerprints(make(rows).repartition(3)).collect()
    assert Counter(map(tuple, got)) == expected


def test_fingerprints_find_edits(make):
    draw = random.Random(4)
    words = [f"word{i}" for i in range(5000)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randrange(12, 400))), "en", "a") for i in range(80)]
    got = syncmers.edited_fingerprints(make(rows)).collect()
    assert all(r.near_edited > 0.3 and r.near_next < 0.05 for r in got if r.n_chars > 300)
    assert all(r.near_edited > r.near_next for r in got)
    # Syncmers bear insertions: what follows keeps its anchors.
    text = rows[0][1]
    moved = syncmers.let(syncmers.anchors(F.lit("one two three " + text)), syncmers.marks)
    plain = syncmers.let(syncmers.anchors(F.lit(text)), syncmers.marks)
    near = make(rows).limit(1).select(syncmers.let(moved, lambda a: syncmers.let(plain, lambda b: syncmers.likeness(a, b))).alias("x"))
    assert near.first().x > 0.8


def test_fingerprints_of_one_row_and_none(make):
    one = syncmers.edited_fingerprints(make([(1, "abcdefgh ijkl", "en", "a")])).collect()
    assert [r.edited_sha256 for r in one] == [sha("abcdefgh i" + "abc")]
    assert syncmers.edited_fingerprints(make(EDGE).limit(0)).collect() == []


# --- periodic runs ----------------------------------------------------------------------


def plain_runs(words, min_words=24, min_periods=3):
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(min_words, min_periods * q):
                part = words[start : start + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    found.append((start, length, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts():
    draw = random.Random(5)
    for _ in range(150):
        words = []
        while len(words) < draw.randrange(0, 160):
            if draw.random() < 0.5:
                words += draw.choices("abc", k=draw.randrange(0, 30))
            else:
                block = draw.choices("abcd", k=draw.randrange(1, 25))
                words += (block * 60)[: draw.randrange(1, 120)]
        yield draw.choice([" ", "\n", "  "]).join(words)


@pytest.mark.parametrize("min_words", [24, 5])
def test_runs(make, min_words, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 300)
    rows = [(i, t, "en", "a") for i, t in enumerate(periodic_texts())]
    got = {r.doc_id: r for r in periodic_runs.find_runs(make(rows), min_words=min_words).collect()}
    assert any(len(r.runs) > 1 for r in got.values())
    for i, text, *_ in rows:
        words = brute.words(text)
        runs = plain_runs(words, min_words)
        assert [tuple(r) for r in got[i].runs] == runs
        assert got[i].collapsed == plain_collapsed(words, runs)


def test_run_edges(make):
    got = periodic_runs.find_runs(make(EDGE))
    assert [c for c in got.columns if c.lower() in ("runs", "collapsed", "best")] == ["runs", "best", "collapsed"]
    assert got.select("found").distinct().first().found == "x"
    rows = got.collect()
    assert len(rows) == len(EDGE)
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(r) for r in by_id[6].runs] == [(0, 60000, 1)] and by_id[6].collapsed == "mot fin"
    assert by_id[2].runs == [] and by_id[2].collapsed == "" and by_id[2].best is None
    assert periodic_runs.find_runs(make(EDGE).limit(0)).collect() == []


def test_run_digests(make):
    rows = [(5000 + i, t, "en", "a") for i, t in enumerate(periodic_texts())]
    # The ids of these hold planted runs, of texts with few words too.
    planted = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, " ".join(f"w{j}" for j in range(n * 7)), "en", "a") for n, i in enumerate(planted)] + EDGE
    expected = Counter()
    for doc_id, text, *_ in rows:
        words = brute.words(text)
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words) if len(words) < 10_000 else [(0, words.count("mot"), 1)]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        expected[(
            doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapsed(words, runs)),
        )] += 1
    got = periodic_runs.run_digests(make(rows)).collect()
    assert Counter(map(tuple, got)) == expected
    assert sum(r.n_runs > 0 for r in got if r.doc_id in planted) > len(planted) // 2
