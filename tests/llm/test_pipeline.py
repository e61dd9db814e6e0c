"""Each stage on its own written input, and the whole run, against plain Python."""

import hashlib
import re
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from flowmart.llm.common import write_out
from flowmart.llm.queries import QUERIES, tokenizer_path
from flowmart.llm.simhash import fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(spark.read.parquet(write_out(stage(spark, out[-1], SF), "test", name)))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, steps):
    columns = steps[0].columns
    assert all(s.columns == columns for s in steps[:-1])
    start, known, exact, near, clean = map(rows, steps[:-1])
    assert set(known) == {k for k, r in start.items() if re.search(r"[^\W\d_]", r.text or "")}
    groups = defaultdict(list)
    for k, r in known.items():
        groups[hashlib.sha256((r.text or "").encode().lower()).digest()].append(k)
    assert set(exact) == {max(g) for g in groups.values()}
    prints = [(k, fingerprint(r.text)) for k, r in sorted(exact.items())]
    parent = {k: k for k in exact}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 3:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    assert set(near) == {find(k) for k in exact}
    words = lambda t: f" {' '.join(re.findall(r'[^\W\d_]+', (t or '').lower()))} "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(clean) == {k for k, r in near.items() if not any(i in words(r.text) for i in items)}
    tok = Tokenizer.from_file(tokenizer_path())
    total = defaultdict(int)
    for r in steps[-1].collect():
        total[r.doc_id] += r.length
    assert total == {k: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for k, r in clean.items()}


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == steps[-1].count()
    assert corpus_pipeline.ORACLE_SQL is None and len(QUERIES) == 13
