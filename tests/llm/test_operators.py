"""Operators of the llm folder against brute force, on rows made to be awkward."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stepmark.llm import (
    common,
    decontaminate,
    embedding_dedup,
    language,
    mixing,
    ngram_join,
    quality,
    secrets,
    shingles,
    suffix_dedup,
    token_files,
    wrappers,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, matches string, features int"
RANDOM = random.Random(5)
LETTERS = {"xx": "abcdefgh ", "yy": "stuvwxyz "}


def words(n, rng=RANDOM):
    return ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus():
    """Near copies, copies, a passage of several, NULLs, empty and very long texts, equal ids."""
    rng = random.Random(9)
    base = words(120, rng)
    near = [*base[:60], "zugabe", *base[61:]]
    passage = " ".join(words(30, rng))
    texts = [" ".join(base), " ".join(near), " ".join(base), "  ".join(base).upper() + "!", None, "", "one two", "one two", "   ", "-- ##"]
    texts += [" ".join([*words(40, rng), passage, *words(40, rng)]) for _ in range(6)]
    texts += [" ".join(words(30_000, rng)), "a" * 300, "é" * 70, "tok <|endoftext|> A.b, it's 12,5  x"]
    texts += [f"password = {'abc123' * 3} and 0123456789abcdef0 AKIA{'Z9' * 8} token=short", f"key {''.join(rng.choice(secrets.ALPHABETS['alnum']) for _ in range(96))} aaaaaaaaaaaaaaaaaaaaaaaa1"]
    rows = [(i, t, "xx" if i % 2 else None, ["b", "a", None][i % 3], 0, 0.5, "m", 1) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, texts[0], "xx", "a", 0, 0.5, "m", 1), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def key(row):
    return tuple((v is not None, v) for v in row)


def grams(text, n=5):
    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] or ([tuple(w)] if w else [])


def reach(n, pairs):
    label = list(range(n))
    while True:
        new = label[:]
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return label
        label = new


def test_secrets(docs, rows, empty):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    expected = []
    for r in rows:
        text = r[1] or ""
        base = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        expected.append((r[0], ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base))))
    found = secrets.find_secrets(docs).select("doc_id", secrets.as_text(F.col("base")).alias("b"), "n_random", secrets.as_text(F.col("found")).alias("f")).collect()
    assert sorted(((r.doc_id, r.b) for r in found), key=key) == sorted(expected, key=key)
    key_text = next(r[1] for r in rows if r[1] and r[1].startswith("key "))
    spans = [r.f for r in found if r.f and "random" in r.f]
    end = key_text.index(" ", 4)
    assert spans == [f"random:4:{end},hex:{end + 1}:{len(key_text)}"], "the random string, and the run of one letter only by its pattern"
    assert secrets.find_secrets(empty).count() == 0


def test_short_secrets_among_ordinary_strings(spark):
    """Planted keys of 20 to 40 characters among thousands of paths, names and dates."""
    rng = random.Random(12)
    word = lambda: rng.choice(["user", "local", "python", "packages", "request", "handler", "Index", "report", "Client", "archive", "window", "thread"])
    shapes = [
        lambda: f"/usr/{word()}/{word()}/{word()}-{rng.randint(1, 99)}/{word()}",
        lambda: f"get_{word()}_{word()}_from_{word()}_v{rng.randint(1, 9)}",
        lambda: f"{word()}{word().title()}{word().title()}{word().title()}{rng.randint(1, 9)}",
        lambda: f"{word()}-2024-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(100000, 235959)}",
    ]
    rows = [(i, f"see {rng.choice(shapes)()} here") for i in range(4000)]
    keys = {}
    for n in (20, 24, 32, 40):
        for name in ("alnum", "base64") * 10:
            keys[4000 + len(keys)] = "".join(rng.choice(secrets.ALPHABETS[name]) for _ in range(n))
    keys[5000] = f"/srv/{word()}/{word()}/{keys[4020]}/{word()}/{word()}"
    rows += [(i, f"see {k} here") for i, k in keys.items()]
    found = {r.doc_id for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).where("n_random > 0").collect()}
    share = lambda first, last: len(found & set(range(first, last))) / (last - first)
    assert share(4000, 4020) >= 0.8 and share(4020, 4040) >= 0.8 and share(4040, 4080) >= 0.95, "20, 24, and 32 or 40 characters"
    assert 5000 in found and len(found - keys.keys()) <= 0.1 * len(found)


def test_mix(spark, docs, rows, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and mixing.mix(empty).count() == 0
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        full = {s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]}
        if not full:
            target |= {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        free -= full
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(key, again)) == sorted(map(key, got))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0


def test_language(spark, docs, empty):
    rng = random.Random(3)
    made = [(i, "".join(rng.choice(LETTERS[lang]) for _ in range(300)), lang) for i in range(60) for lang in LETTERS]
    known = spark.createDataFrame([(2 * i + (lang == "yy"), t, lang) for i, t, lang in made], "doc_id long, text string, lang string")
    out = common.held_out(F.col("doc_id"), 4, 2)
    model = language.train(known, ~out)
    guessed = language.predict(known, model)
    assert guessed.where(out).count() > 10 and guessed.where("lang <> lang_pred").count() == 0
    awkward = language.predict(docs, model)
    assert awkward.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score"]
    for r in awkward.collect():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
    assert language.train(empty, F.lit(True)) is None
    assert language.predict(docs, None).where("lang_pred <> 'und'").count() == 0


def test_kernel_is_shared_grams():
    texts = ["abcabc", "bca", "xyz" * 9, ""]
    model = language.fit(["abcabc", "xyz"], ["p", "q"])
    features = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    for row, text in zip(model.similarities(texts[:2]), texts[:2], strict=True):
        for value, mark in zip(row, ["abcabc", "xyz"], strict=True):
            a, b = features(text), features(mark)
            assert value == pytest.approx(len(a & b) / np.sqrt(len(a) * len(b)), abs=1e-6)
    assert (model.similarities([""]) == 0).all()


def test_language_learns_from_whole_texts(spark):
    """Labelled texts that begin alike and differ late, and more characters than any small alphabet."""
    rng = random.Random(8)
    letters = {"pp": [chr(0x4E00 + i) for i in range(300)], "qq": [chr(0x4E00 + i) for i in range(300, 600)]}
    late = lambda lang, n: "".join(rng.choice(letters[lang]) for _ in range(n))
    known = [(i, "1234 5678 " * 2_100 + late(lang, 3_000), lang) for i in range(30) for lang in letters]
    known = spark.createDataFrame([(2 * i + (lang == "qq"), t, lang) for i, t, lang in known], "doc_id long, text string, lang string")
    model = language.train(known, F.lit(True))
    asked = spark.createDataFrame([(i, late(lang, 200), lang) for i in range(20) for lang in letters], known.schema)
    assert language.predict(asked, model).where("lang <> lang_pred").count() == 0
    best = {}  # one row for each language and part of the hashes, as in the sample
    for r in known.withColumn("h", F.xxhash64("doc_id")).orderBy(F.desc("h")).collect():
        best[r.lang, r.h % language.TRAIN_PER_CLASS] = r
    texts, labels = zip(*[(r.text, r.lang) for r in sorted(best.values(), key=lambda r: (r.lang, r.h))], strict=True)
    plain = language.fit(list(texts), list(labels))
    assert (plain.features == model.features).all() and np.allclose(plain.weights, model.weights, atol=1e-4)


def test_quality(spark, docs, empty):
    rng = random.Random(4)
    good = [(i, " ".join(words(60, rng)).capitalize() + ".", 1) for i in range(300)]
    bad = [(300 + i, " ".join(w + "###" for w in words(60, rng)), 0) for i in range(300)]
    known = spark.createDataFrame([*good, *bad], "doc_id long, text string, label int")
    model = quality.train(known.where("doc_id % 3 <> 0"), known)
    scored = quality.score(known, model).where("doc_id % 3 = 0").collect()
    assert np.mean([(r.score >= 0.5) == (r.label == 1) for r in scored]) > 0.95
    assert all(0 <= r.score <= 1 for r in quality.score(docs, model).collect())
    untaught = quality.train(empty, known)
    assert all(r.score == 0.5 for r in quality.score(docs, untaught).collect())


def test_extract(spark):
    head = "<html><head><title>T</title></head><body><nav><a>Menu</a></nav>"
    article = "<article><h1>Head &amp; more</h1><p><b>One\n two<br>three<p>Four&nbsp;five<div class='comments'><p>No</div></article>"
    plain = lambda i: f"{head}<div><p>Welcome to us</p><p>Body {i}</p><p>Same for all</p></div><div id=sidebar>x</div></body>"
    pages = [(i, "http://h.example/a", plain(i)) for i in range(8)] + [(8, "http://g.example/b", head + article + "<footer>f</footer>")]
    pages += [(9, None, None), (10, "odd", ""), (11, "http://h.example/a", "just <i>te</i>xt <!-- c --> < 3 <script>if (a<b) {}</script>"), (8, *pages[8][1:])]
    df = spark.createDataFrame([(*p, "u") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    assert all(got[i] == f"Body {i}" for i in range(8)), "what all pages of a host share is template"
    assert got[8] == "Head & more\nOne two three\nFour five"
    assert got[9] == got[10] == "" and got[11] == "just text < 3"
    assert wrappers.extract(df).count() == len(pages) and wrappers.extract(df.limit(0)).count() == 0


def test_template_does_not_hang_on_one_page(spark):
    """Empty pages, an error page, another layout and an optional notice on one host."""
    notice = "<div class=hint><p>We moved</p></div>"
    usual = lambda i: f"<html><body>{notice if i % 5 < 3 else ''}<section><p>Welcome</p></section><div><p>Body {i}</p></div></body></html>"
    other = lambda i: f"<table><tr><td>Old menu</td></tr><tr><td><p>Row {i}</p></td></tr></table>"
    pages = [(i, f"http://h.example/{i}", usual(i)) for i in range(40)] + [(100 + i, f"http://h.example/o{i}", other(i)) for i in range(12)]
    pages += [(200 + i, f"http://h.example/e{i}", None if i % 2 else "") for i in range(60)]
    pages += [(300, "http://h.example/x", "<html><body><div><p>Not found</p></div></body></html>")]
    pages += [(400, "http://h.example/copy", "<html><body><h2><p>Copied</p></h2></body></html>")] * 30
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    assert all(got[i] == f"Body {i}" for i in range(40)), "the optional notice is template as well"
    assert all(got[100 + i] == f"Row {i}" for i in range(12)), "so is the menu of the other layout"
    assert all(got[200 + i] == "" for i in range(60)) and got[300] == "Not found" and got[400] == "Copied"


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<div class='layout has-sidebar'><article><p>A</p></article><div class=sidebar>s</div></div>", "A"),
        ("<div class='post comments-open'><p>A</p></div><p>b</p>", "A b"),
        ("<div class=search-results><p>A</p></div>", "A"),
        ("<article><p>A</p><section id=related-work><p>B</p></section><div class=share>s</div></article>", "A B"),
        ("<form id=aspnet><div><article><p>A</p></article></div><div class=comments>c</div></form>", "A"),
        ("<form><p>A long body of the page</p></form><p>b</p>", "A long body of the page b"),
        ("<p>A long body of the page</p><form><p>mail</p></form>", "A long body of the page"),
        ("<div class=sidebar><main><p>A</p></main></div><p>b</p>", "A"),
        ("<article><p>A</p></article><article class=comment><p>A much longer answer</p></article>", "A"),
        ("<article><p>A</p></article><div class=related><article><p>Another one, longer</p></article></div>", "A"),
        ("<p>A long body</p><ul class=comment-list><li>c</ul><div class=site-nav>n</div>", "A long body"),
        ("<p>A long body</p><div style='display:none'><article>x</article></div><div hidden>y</div>", "A long body"),
    ],
)
def test_names_drop_no_article(page, expected):
    found = wrappers.parse(f"<html><body>{page}</body></html>")
    assert " ".join(t for node, _, t in found.blocks if node.article or not found.articles) == expected


def test_tree_matching():
    rng = random.Random(6)

    def tree(depth):
        return "<div>" + "".join(tree(depth - 1) if depth and rng.random() < 0.6 else f"<{rng.choice(['p', 'h2'])}>x" for _ in range(rng.randint(0, 4))) + "</div>"

    def plain(a, b):
        if a.tag != b.tag:
            return 0
        t = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children):
            for j, y in enumerate(b.children):
                t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + plain(x, y))
        return 1 + t[-1][-1]

    for _ in range(60):
        a, b = wrappers.parse(tree(3)).root, wrappers.parse(tree(3)).root
        assert wrappers.matched(a, b) == plain(a, b) == len(wrappers.align(a, b))


def test_jaccard_join(docs, rows, empty):
    sets = [set(grams(r[1])) if r[0] is not None else set() for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    label, links = reach(len(rows), linked), Counter(x for p in linked for x in p)
    names = {c: min((rows[i][0] for i in range(len(rows)) if label[i] == c and rows[i][0] is not None), default=None) for c in set(label)}
    expected = [(r[0], names[label[i]], links[i]) for i, r in enumerate(rows)]
    got = ngram_join.jaccard_join(docs).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(key, got)) == sorted(map(key, expected)) and len(linked) > 5
    assert ngram_join.jaccard_join(empty).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    gone = {r[0] for r, e in zip(rows, expected, strict=True) if r[0] is not None and e[1] != r[0]}
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - gone


def test_jaccard_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rng = random.Random(8)
    base = words(80, rng)
    texts = []
    for _ in range(60):
        text = base[:]
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(80)] = rng.choice(words(3, rng))
        texts.append(" ".join(text))
    sets = [set(grams(t)) for t in texts]
    linked = [(i, j) for i in range(60) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    links = Counter(x for p in linked for x in p)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.jaccard_join(df).collect()
    assert {r.doc_id: r.n_links for r in got} == {i: links[i] for i in range(60)}
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(reach(60, linked)))


def test_bands_reach_the_recall():
    bands, rows_ = ngram_join.banding(0.8)
    assert ngram_join.recall_of(0.8, bands, rows_) >= ngram_join.RECALL and bands * rows_ <= ngram_join.MOST_HASHES


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PIECE", 20)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    x = [c + rng.normal(size=24) * rng.choice([0.1, 0.3, 0.5]) for c in centres for _ in range(12)]
    vectors = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, []), (904, [1.0, None])]
    vectors += [(905, [2.0, 0.0]), (906, [1.0, 0.1]), (907, (3 * x[0]).tolist()), (0, x[0].tolist()), (None, x[0].tolist())]
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, label int")
    ok = [i for i, v in enumerate(vectors) if v[0] is not None and v[1] and None not in v[1] and np.isfinite(v[1]).all() and any(v[1])]
    cos = lambda a, b: np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    linked = [(i, j) for i in ok for j in ok if j < i and len(vectors[i][1]) == len(vectors[j][1]) and cos(vectors[i][1], vectors[j][1]) >= 0.9]
    label, links = reach(len(vectors), linked), Counter(y for p in linked for y in p)
    names = {c: min((vectors[i][0] for i in range(len(vectors)) if label[i] == c and vectors[i][0] is not None), default=None) for c in set(label)}
    expected = [(v[0], links[i], names[label[i]]) for i, v in enumerate(vectors)]
    got = embedding_dedup.near_duplicates(df).select("vec_id", "n_links", "component_id").collect()
    assert sorted(map(key, got)) == sorted(map(key, expected)) and len(linked) > 100
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_are_compared_about_once_a_block():
    units = np.random.default_rng(8).normal(size=(1500, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    cells = embedding_dedup.Blocks.of(units, 0.9).cells(units).T
    met = sum(int((abs(c[:, None] - c[None, :]) <= 1).sum()) for c in cells)
    assert met <= 2 * len(units) ** 2, "pairs of the same or neighbouring cells, in all blocks"


@pytest.mark.parametrize("dims", [64, 100])
def test_embeddings_in_several_blocks(spark, monkeypatch, dims):
    monkeypatch.setattr(embedding_dedup, "PIECE", 40)
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(dims)
    seeds = rng.normal(size=(30, dims))
    x = seeds[rng.integers(0, 30, 250)] + rng.normal(size=(250, dims)) * rng.uniform(0.1, 0.45, (250, 1))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.9) & ~np.eye(250, dtype=bool)
    assert 300 < linked.sum() < 10_000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    least = np.arange(250)
    for _ in range(250):
        least = np.minimum(least, np.where(linked, least[None, :], 250).min(axis=1))
    assert got == {i: (int(linked[i].sum()), int(least[i])) for i in range(250)}


def test_token_files(spark, docs, rows, empty, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    manifest = token_files.write_token_files(docs, f"file://{tmp_path}/t", path, length=64)
    got = token_files.read_token_files(manifest).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected, stream = 0, [], []
    for r in ordered:
        ids = [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        stream += ids
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    held = []
    for f in sorted(manifest.collect(), key=lambda r: r.part):
        file = token_files.TokenFile(f.path)
        for s in range(-(-f.n_tokens // 64)):
            ids, mask = file.sequence(s)
            assert len(ids) == len(mask) == 64 and ids.base is not None, "a view, not a copy"
            held += ids[mask].tolist()
    assert held == stream
    assert token_files.read_token_files(token_files.write_token_files(empty, f"{tmp_path}/e", path)).count() == 0


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup(docs, rows, empty, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    expected = []
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for d, b in data:
        for s in range(len(b) - 49) if d is not None else ():
            w = b[s : s + 50]
            least[w] = min(d, least.get(w, d))
    for d, b in data:
        gone = np.zeros(len(b), dtype=bool)
        for s in range(len(b) - 49) if d is not None else ():
            if least[b[s : s + 50]] < d:
                gone[s : s + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        expected.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    got = suffix_dedup.dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(key, got)) == sorted(map(key, expected))
    assert sum(e[2] > 0 for e in expected) > 5
    assert suffix_dedup.dedup(empty).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(1)
    for letters in (2, 3, 40):
        text = np.zeros(900, dtype=np.uint8)
        wanted = np.zeros(900 - 64, dtype=bool)
        at = 0
        while at < 600:
            n = int(rng.integers(50, 90))
            text[at : at + n] = rng.integers(1, letters + 1, n)
            if at > 200:
                text[at : at + 50] = text[at - 150 : at - 100]
            wanted[at : at + n - 49] = True
            at += n + 1
        wanted &= text[: len(wanted)] > 0
        got, same = suffix_dedup.sorted_windows(text, wanted)
        assert sorted(got.tolist()) == np.flatnonzero(wanted).tolist()
        prefixes = [bytes(text[p : p + 50]) for p in got]
        assert prefixes == sorted(prefixes)
        assert [False] + [a == b for a, b in zip(prefixes, prefixes[1:], strict=False)] == same.tolist()


def test_decontaminate(spark, docs, rows, empty):
    passage = next(r[1] for r in rows if r[0] == 12).split()
    items = [(1, " ".join(passage[40:70])), (2, " ".join([*passage[40:55], "other", *passage[55:70]])), (3, "one two"), (4, None), (5, " ".join(words(20)))]
    items += [(None, " ".join(passage[40:70])), (1, " ".join(passage[40:70]))]
    bench = spark.createDataFrame([(*i, "q") for i in items], "item_id long, text string, lang string")
    expected = []
    for r in rows:
        g = grams(r[1]) if len(grams(r[1], 1)) >= 5 else []
        for item, text in items:
            w = Counter(grams(text))
            if not g or len((text or "").split()) < 5:
                continue
            n = min(len(grams(text)), len(g))
            near = [sum((w & Counter(g[s : s + n])).values()) / sum((w | Counter(g[s : s + n])).values()) for s in range(len(g) - n + 1)] if len(g) < 1000 else [0]
            if max(near) >= 0.8:
                expected.append((r[0], item, round(max(near), 9)))
    got = decontaminate.contaminated(docs, bench).collect()
    assert sorted(key((r.doc_id, r.item_id, round(r.similarity, 9))) for r in got) == sorted(map(key, expected)) and len(expected) > 10
    cleaned = decontaminate.clean(docs, bench)
    assert cleaned.columns == docs.columns and cleaned.count() == len([r for r in rows if r[0] not in {e[0] for e in expected}])
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_fingerprint_index_misses_none():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 16, (50, 8), dtype=np.uint16)
    queries = np.repeat(prints, 8, axis=0)
    for i, q in enumerate(queries):
        for bit in rng.choice(128, i % 60, replace=False):
            q[bit // 16] ^= np.uint16(1 << (bit % 16))
    apart = decontaminate.SET_BITS[queries[:, None] ^ prints[None]].sum(axis=2, dtype=np.int64)
    expected = set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= decontaminate.RADIUS)), strict=True))
    assert set(zip(*map(np.ndarray.tolist, decontaminate.MultiIndex(prints).near(queries)), strict=True)) == expected


def test_words():
    texts = ["Hello, wörld! a b", None, "", "x" * (3 * shingles.SEGMENT) + " y z", "a.b.c É"]
    hashes, at = shingles.words(texts)
    found = [re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower()) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in found]
    names = {}
    assert all(names.setdefault(w, h) == h for w, h in zip((w for ws in found for w in ws), hashes, strict=True))


def test_components(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    label = reach(200, pairs)
    got = common.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: label[x] for p in pairs for x in p if p[0] != p[1] or label.count(label[x]) > 1}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
