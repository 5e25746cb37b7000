"""The pipeline over a small corpus with planted cases, against brute force; clashing columns."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stepmark.llm import decontaminate, language, mixing, token_files, wrappers

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, matches string, lang_pred string, __x int"
LETTERS = {"xx": "abcdefghij", "yy": "qrstuvwxyz"}


def words(rng, lang, n):
    return ["".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(3, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    """Documents of two languages; copies, near copies, passages of items, and rows without words."""
    rng = random.Random(31)
    texts = {i: " ".join(words(rng, "xx" if i % 2 else "yy", 80)) for i in range(120)}
    items = {k: " ".join(words(rng, "xx", 30)) for k in range(3)}
    near = texts[10].split()
    near[40] = "qqqq"
    texts |= {200: texts[10], 201: " ".join(near), 202: texts[11], 203: texts[11].upper()}
    for k, i in enumerate((300, 301, 302)):
        texts[i] = " ".join([*words(rng, "xx", 30), items[k], *words(rng, "xx", 30)])
    texts |= {400: None, 401: "", 402: "12 34 !!", 403: "  "}
    rows = [(i, t, ("xx" if t and set(t.lower()) & set("abcdefghij") else "yy") if i < 120 else None, f"s{i % 3}" if i % 7 else None, 0, 0.25, "m", "p", 5) for i, t in texts.items()]
    return rows, items


def grams(text):
    w = re.findall(r"[a-z0-9]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_run_against_brute_force(spark, planted, tmp_path):
    rows, items = planted
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*items.items(), (9, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, stage = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES)
    values = lambda df: sorted(map(tuple, df.collect()), key=str)

    told = stage["language_id"](spark, docs, str(tmp_path))
    true = lambda t: "xx" if sum(c in LETTERS["xx"] for c in t.lower()) > sum(c in LETTERS["yy"] for c in t.lower()) else "yy"
    expected = [(r[0], r[1], true(r[1]), *r[3:]) for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    assert told.columns == docs.columns and values(told) == sorted(expected, key=str), "the label takes effect, other columns stay"

    kept = stage["ngram_join"](spark, told, str(tmp_path))
    sets = {r[0]: grams(r[1]) for r in expected}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    expected = [r for r in expected if not any(b < r[0] and alike(b, r[0]) for b in sets)]
    assert {201, 200, 202, 203}.isdisjoint(r[0] for r in expected) and values(kept) == sorted(expected, key=str)

    clean = stage["decontaminate"](spark, kept, str(tmp_path))
    expected = [r for r in expected if not any(item in r[1] for item in items.values())]
    assert len(expected) == 120 and clean.columns == docs.columns and values(clean) == sorted(expected, key=str)

    mixed = stage["source_mix"](spark, clean, str(tmp_path))
    plan = {r["doc_id"]: r["whole"] + (2 * r["extra"] >= r["size"] and r["extra"] > 0) for r in mixing.mix(clean).collect()}
    expected = [r for r in expected for _ in range(plan[r[0]])]
    assert values(mixed) == sorted(expected, key=str)
    taken = Counter()
    for r in expected:
        taken[r[3]] += len(r[1].split())
    total = sum(len(r[1].split()) for r in {r[0]: r for r in expected}.values())
    assert total and max(taken.values()) <= 2 * sum(taken.values())

    tokenizer = token_files.Encoder(token_files.default_tokenizer()).tokenizer
    out, start = [], 0
    for r in sorted(expected, key=lambda r: (r[0], r[1])):
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 2]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(out)


def test_stages_keep_columns_of_any_name(spark, planted):
    rows, items = planted
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns and {r["matches"] for r in clean.collect()} == {"m"}
    guessed = language.with_guess(docs, language.train(docs, F.lit(True)))
    assert {(r["score"], r["lang_pred"]) for r in guessed.collect()} == {(0.25, "p")}


def test_each_text_is_scored_once(spark, planted):
    docs = spark.createDataFrame(planted[0], SCHEMA)
    told = corpus_pipeline.identify_language(spark, docs, "")
    assert told._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1, "a second one is a second worker a task"
    guessed = language.predict(docs, language.train(docs, F.lit(True))).where("lang_pred <> 'und' and score > 0.1")
    assert guessed._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r["doc_id"] for r in guessed.collect()} == {r[0] for r in planted[0] if r[1] and any(map(str.isalpha, r[1]))}


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<article class='post hidden lg:block'><p>A</p></article>", "A"),
        ("<article aria-label='The hidden cost of tea'><p>A</p></article>", "A"),
        ("<p title='a hidden gem'>A long body</p>", "A long body"),
        ("<p>See <a title='the hidden door'>the door</a> there</p>", "See the door there"),
        ("<p data-x='display: none'>A</p><p style='color:red; display : none'>b</p>", "A"),
        ("<p>A</p><p HIDDEN>b</p><p hidden=until-found>c</p><p title=hidden>D</p>", "A D"),
    ],
)
def test_the_word_hidden_hides_nothing(page, expected):
    found = wrappers.parse(f"<html><body>{page}</body></html>")
    assert " ".join(t for node, _, t in found.blocks if node.article or not found.articles) == expected
