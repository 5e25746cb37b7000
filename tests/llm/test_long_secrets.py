"""The secret scan on texts that are one long list."""

import random
import re
import time

from pyspark.sql import functions as F

from stepmark.llm import secrets


def test_secrets_of_a_long_list(spark):
    """A megabyte of hexadecimal runs, and one of assignments: spans as by a plain search, in bounded time."""
    rng = random.Random(3)
    runs = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(10, 24))) for _ in range(57_000))
    named = "\n".join(f"token = {''.join(rng.choice('ABCxyz012') for _ in range(rng.randint(9, 15)))}" for _ in range(6_000))
    texts = [runs, named, f"{named} {runs[:50_000]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    started = time.time()
    found = {r["doc_id"]: r for r in secrets.find_secrets(docs).select("doc_id", "n_assign", "n_hex", secrets.as_text(F.col("base")).alias("b")).collect()}
    assert time.time() - started < 60
    for i, text in enumerate(texts):
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"token = ([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 12]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        assert found[i]["b"] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
