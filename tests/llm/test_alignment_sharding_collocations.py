"""Sharding, tokenizer alignment and collocations against brute force, on awkward rows."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stepmark.llm import alignment, collocations, pieces, queries, sharding

SCHEMA = "doc_id long, text string, lang string, size long, digest string, part int, shard string, links array<int>, phrase string"
EXTRA = (1, "d", 2, "s", [1], "p")


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, lang, *EXTRA) for i, t, lang in rows], SCHEMA).repartition(parts)


def test_differencing():
    assert sharding.differencing([], 3) == [] and sharding.differencing([5, 1], 1) == [0, 0]
    assert sharding.differencing([8, 7, 6, 5, 4], 2) == [0, 1, 0, 1, 1], "the textbook case: 14 and 16"
    rng = random.Random(1)

    def sums(sizes, piles, k):
        out = [0] * k
        for s, p in zip(sizes, piles, strict=True):
            out[p] += s
        return out

    for _ in range(200):
        k, sizes = rng.randint(2, 3), [rng.randint(0, 40) for _ in range(rng.randint(1, 7))]
        best = min(max(sums(sizes, p, k)) for p in product(range(k), repeat=len(sizes)))
        assert max(sums(sizes, sharding.differencing(sizes, k), k)) <= best * 7 / 6 + 1e-9, "the proven ratio for two piles is 7/6"
    sizes = [rng.randint(1, 10**6) for _ in range(3000)]
    dealt = sums(sizes, sharding.differencing(sizes, 24), 24)
    largest_first = [0] * 24
    for s in sorted(sizes, reverse=True):
        largest_first[largest_first.index(min(largest_first))] += s
    assert max(dealt) - min(dealt) <= 30 < max(largest_first) - min(largest_first)


def check_shards(rows, got, shards, text_of):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    for s in range(shards):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    of_text = {}
    for r in got:
        assert 0 <= r.shard < shards and of_text.setdefault(text_of(r), r.shard) == r.shard, "equal texts stay together"


def test_sharding(spark, tmp_path):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc é日") for _ in range(rng.randint(0, 900))) for _ in range(1500)]
    texts += ["copy " * 40] * 700 + [None, "", None, "x" * 200_000]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(7, texts[7], None), (None, "nameless", None), (None, None, None)]
    docs = frame(spark, rows)
    got = sharding.shard(docs).collect()
    check_shards(rows, got, 24, lambda r: (r.size, r.text_crc32))
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    alone = {next(r.shard for r in got if r.size > 200_000), next(r.shard for r in got if r.text_crc32 == zlib.crc32(b"copy " * 40))}
    rest = [sizes[s] for s in range(24) if s not in alone]
    assert len(alone) == 2 and sorted(sizes, key=sizes.get)[-2:] == sorted(alone, key=sizes.get)
    assert max(rest) - min(rest) <= 0.002 * max(rest), "the others share what is left evenly"
    again = sharding.shard(docs.repartition(2)).collect()
    assert Counter((r.doc_id, r.size, r.shard) for r in again) == Counter((r.doc_id, r.size, r.shard) for r in got)
    assert sharding.shard(docs.limit(0)).count() == 0
    few = sharding.shard(frame(spark, rows[:3]), shards=2).collect()
    check_shards(rows[:3], few, 2, lambda r: (r.size, r.text_crc32))
    with pytest.raises(ValueError, match="at least one"):
        sharding.shard(docs, shards=0)

    written = sharding.write_shards(docs, str(tmp_path / "shards"), files=3, column="dealt")
    assert written.columns == [*docs.columns, "dealt"]
    assert sorted(map(str, written.drop("dealt").collect())) == sorted(map(str, docs.collect()))
    shard_of = {(r.doc_id, r.size): r.shard for r in got}
    assert all(r.dealt == shard_of[r.doc_id, len((r.text or "").encode()) + 8] for r in written.collect())
    with pytest.raises(ValueError, match="column of the documents"):
        sharding.write_shards(docs, str(tmp_path / "other"))


tokenizers = pytest.importorskip("public_tokenizers")
PARTS = [", ", ".", "e,", "é? ", "a", "b", "the", " ", "  ", "\n", "\t", "é", "日", "😀", "　", "\xa0", "\x1c", ".", "12", "<|endoftext|>", "<s>", "▁", "é", "\r\n", "{\r", "\x00", "ß", "'s", "ﬁ", "बड़", "<0x0A>"]


@pytest.fixture(scope="module")
def both():
    return pieces.Aligner(*alignment.default_tokenizers())


def plain(both, text):
    """Ids, groups and links of one whole text, from decoded bytes alone."""
    nothing = ([], [], "", [])
    if not text:
        return nothing
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    bytes_a, bytes_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return nothing
    ends_a, ends_b = np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()
    groups, links, i, j = [], [], 0, 0
    for end in sorted({*ends_a} & {*ends_b}):
        to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, a[i:to_a])) + "|" + ",".join(map(str, b[j:to_b])))
        links += [(x, y) for x in [a[to_a - 1]] for y in [b[to_b - 1]]]
        i, j = to_a, to_b
    return a, b, ";".join(groups), links


def same_as_plain(both, texts):
    for text, got in zip(texts, both.align(texts), strict=True):
        a, b, groups, links = plain(both, text)
        assert (got.n_a, got.n_b, got.groups) == (len(a), len(b), groups), text
        assert [divmod(x, both.n_b) for x in got.links.tolist()] == links


def test_alignment_of_pieces_is_that_of_whole_texts(both, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    ranges = [(32, 0x2FF), (0x300, 0x36F), (0x400, 0xD7FF), (0x1F300, 0x1FAFF)]
    texts += ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(1, 15))) for _ in range(1500)]
    texts += [None, "", " ", "   ", "x" * 50_000, "日" * 3000]
    same_as_plain(both, texts)
    monkeypatch.setattr(pieces, "MOST_CACHED", 3)
    monkeypatch.setattr(pieces, "JOINED", 2)
    for at in range(0, 60, 7):
        same_as_plain(both, texts[at : at + 7])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=4))
def test_alignment_of_any_text(both, texts):
    same_as_plain(both, texts)


def test_ends_of_tokens_that_share_a_character(both):
    text = " 日😀"
    encoded = both.a.encode(text, add_special_tokens=False)
    assert len({*encoded.offsets}) < len(encoded.offsets) or any(b - a > 1 for a, b in encoded.offsets)
    got = next(both.align([text[1:]]))
    assert got.n_a == len(encoded.ids) and sum(len(g.split("|")[0].split(",")) for g in got.groups.split(";")) == got.n_a
    # spans: a sure token, two that share a character of three bytes, a sure one
    n = lambda *x: np.array(x, dtype=np.int64)
    assert pieces.ends(n(1, 4, 4, 5), n(1, 2, 1, 1), n(1, 0, 0, 0).astype(bool), n(0, 0, 0, 0)).tolist() == [1, 3, 4, 5]
    # a text that begins at 7 with an unsure token is not refined from the text before
    assert pieces.ends(n(5, 10, 10), n(1, 1, 2), n(1, 1, 0).astype(bool), n(4, 7, 7)).tolist() == [5, 8, 10]


def test_alignment(spark, both):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "cat", "Straße", "日本", "x1", "don't"]) for _ in range(rng.randint(1, 40))) for _ in range(80)]
    texts += [None, "", "a▁b", "😀😀", texts[0], "y" * 3000]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(0, texts[0], None), (None, texts[3], None)]
    expected, counts = [], Counter()
    for i, t, _ in rows:
        expected.append((i, *plain(both, t)))
        counts.update(expected[-1][4])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    paths = alignment.default_tokenizers()
    got = alignment.align(frame(spark, rows), *paths)
    brute = Counter(
        (i, len(a), len(b), len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if a else "")
        for i, a, b, g, links in expected
    )
    assert Counter(map(tuple, got.collect())) == brute and len(brute) > 60
    assert len(counts) <= alignment.most_pairs(both)
    assert alignment.align(frame(spark, rows).limit(0), *paths).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=60), min_size=1, max_size=6), st.integers(1, 8))
def test_misra_gries(streams, capacity):
    """Counts are too low by at most mass / (capacity + 1), added or merged."""
    added, merged = collocations.MisraGries(capacity), collocations.MisraGries(capacity)
    for stream in streams:
        keys, counts = np.unique(np.array(stream, dtype=np.uint64), return_counts=True)
        added.add(keys, counts)
        part = collocations.MisraGries(capacity)
        for key in stream:
            part.add(np.array([key], dtype=np.uint64), np.array([1]))
        merged.merge(part)
    true = Counter(x for s in streams for x in s)
    for summary in (added, merged):
        held = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
        assert len(held) <= capacity and summary.error * (capacity + 1) <= true.total()
        for key, n in true.items():
            assert n - summary.error <= held.get(key, 0) <= n
            assert n <= 3 or n < summary.error + 1 or key in summary.may_reach(n)
    values = np.sort(np.array([x * 977 for s in streams for x in s], dtype=np.uint64))
    assert (collocations.unpacked(collocations.packed(values), len(values)) == values).all()


def brute_phrases(rows, threshold, longest, covered, top):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = [p for p, a in counts.items() if len(p) > 1 and a >= threshold]
        kept = []
        for p in found:
            a = counts[p]
            inside = lambda q, p=p: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            if any(inside(q) and 100 * counts[q] >= covered * a for q in found):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    words = ["alpha", "Beta", "ÄÖ", "x", "日本", "the", "of", "new\x1cline", " "]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for _ in range(rng.randint(0, 80)))
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    rows += [(200, "new york city " * 30, "fr"), (201, "a a a a a a " * 40, "fr"), (202, None, "en"), (203, "", None), (204, "only", "tiny"), (None, "the of " * 9, "und")]
    return [*rows, rows[0], rows[0]]


@pytest.mark.parametrize(("threshold", "covered", "top"), [(8, 100, 2000), (3, 60, 2000), (8, 100, 5)])
def test_collocations(spark, threshold, covered, top):
    rows = phrase_rows()
    got = collocations.mine(frame(spark, rows), threshold=threshold, covered_percent=covered, top=top)
    expected = brute_phrases(rows, threshold, 5, covered, top)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) >= (15 if top == 5 else 50)
    assert collocations.mine(frame(spark, rows).limit(0)).count() == 0


def test_collocations_with_small_filters(spark, monkeypatch):
    """Filters that let almost everything through, many partitions, small slices: the same result."""
    for name, value in {"WORD_BITS": 6, "PHRASE_BITS": 7, "MASS": 100, "SLICE": 500, "WAITING": 50, "HELD": 20}.items():
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows()
    got = collocations.mine(frame(spark, rows), threshold=8)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 8, 5, 100, 2000)


def test_phrases_of_equal_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(collocations, "mixed", lambda x: (x & np.uint64(1)) << np.uint64(63))
    rows = phrase_rows()[:60]
    got = collocations.mine(frame(spark, rows, 1), threshold=5)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 5, 5, 100, 2000)


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 10**15
    counts = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, 3 * big), ("en", "b", 1, big + 7)], "lang string, phrase string, size int, f long"
    )
    totals = spark.createDataFrame([("en", 9 * 10**17 + 1)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent", lambda *_: (counts, totals))
    (row,) = collocations.mine(counts).collect()
    assert row.score == 1000 * big * (9 * 10**17 + 1) // (3 * big * (big + 7))


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_registered_queries(spark, both):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    dealt = queries.op11_sharding(spark, SF_DIR)
    assert dealt.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = dealt.collect()
    check_shards(docs, got, 24, lambda r: (r.size, r.text_crc32))
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    aligned = {r.doc_id: r for r in queries.op12_token_alignment(spark, SF_DIR).collect()}
    counts = Counter(x for _, t, _ in docs for x in plain(both, t)[3])
    for i, t, _ in docs:
        a, b, groups, links = plain(both, t)
        r = aligned[i]
        assert (r.n_a, r.n_b, r.n_groups, r.count_sum) == (len(a), len(b), len(links), sum(counts[x] for x in links))
        assert r.groups_sha256 == hashlib.sha256(groups.encode()).hexdigest()
    assert sorted(map(tuple, queries.op13_collocations(spark, SF_DIR).collect())) == brute_phrases(docs, 100, 5, 100, 2000)
