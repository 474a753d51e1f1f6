"""The pipeline against a plain version of each of its stages."""

import hashlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from poolwright.llm import decontaminate
from poolwright.llm.common import utf8
from tests.llm import hard
from tests.llm.test_jaccard_join import brute_force as components
from tests.llm.test_suffix_dedup import brute_force as repeats

DATA = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


def plain(docs, items):
    docs = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    group = {i: c for i, _, c in components(docs, 5, Fraction(8, 10))}
    docs = sorted((i, t) for i, t in docs if group[i] == i)
    data = [t.encode() for _, t in docs]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for (i, _), d in zip(docs, data):
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if seen[d[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        text = bytes(c for c, g in zip(d, gone) if not g).decode("utf-8", "ignore")
        if text.strip():
            out.append((i, text))
    index = decontaminate.Index(items, 0.8)

    def holds(text):
        words = decontaminate.Words(*utf8(pa.array([text])))
        whole = words.text(0, len(words.hashes))
        return any(decontaminate.edit_distance_within(item, whole, most) is not None for item, most in zip(index.texts, index.most))

    out = [(i, t) for i, t in out if not holds(t)]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = []
    for i, t in out:
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        rows.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(rows)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no supplied tables")
def test_pipeline_equals_its_plain_version(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{DATA}/documents.parquet").to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{DATA}/benchmark.parquet").to_pylist()]
    got = sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect()))
    assert got == plain(docs, items)
    assert len(got) > 0.6 * len(docs)


def test_stages_take_hard_rows_and_return_the_columns_of_documents(spark, tmp_path):
    bench = spark.createDataFrame([(1, " ".join(hard.rows()[0][1].split()[:30])), (2, None)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (hard.table(spark), hard.empty(spark)):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k + 1 < len(corpus_pipeline.STAGES):
                assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in start.schema], name
            assert out.count() <= docs.count()
            docs = out


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontaminate", "bpe"]
    assert repeats([None]) == [(0, 0, 0, hashlib.sha256(b"").hexdigest())]
