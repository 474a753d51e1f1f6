import hashlib
import random

import duckdb
import numpy as np
import pytest

from poolwright.llm import fill_in_middle as m
from tests.llm import hard


def test_places_equal_sums_of_widths():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 8, 9, 63, 500, 40_000):
        widths = np.array([rng.randint(0, 5) for _ in range(n)], np.int64)
        made = m.SkipList(widths)
        ends = [0, *np.cumsum(widths).tolist()]
        for rank in {0, n, *(rng.randint(0, n) for _ in range(50))}:
            assert made.place(rank) == ends[rank]


def test_lanes_thin_out_and_long_lists_have_them_too(monkeypatch):
    made = m.SkipList(np.ones(20_000, np.int64))
    sizes = [len(units) for units, _, _ in made.lanes]
    assert sizes[0] == 20_000 and len(sizes) >= 4 and all(b < a / 4 for a, b in zip(sizes[:3], sizes[1:4]))
    long_ = m.SkipList(np.ones((1 << 20) + 5, np.int64))
    assert long_.place((1 << 20) + 3) == (1 << 20) + 3 and len(long_.lanes) >= 6


@pytest.mark.parametrize("unit", list(m.UNITS))
def test_units_cover_the_text(unit):
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab \n\t é日\U0001f642") for _ in range(rng.randint(0, 40)))
        widths = m.unit_widths(text, unit)
        assert widths.sum() == len(text) and (widths > 0).all()
        if unit == "word" and text.split():
            assert len(widths) in (len(text.split()), len(text.split()) + 1)
        for doc_id in range(4):
            n, form, output, prefix, middle = m.arrange(text, doc_id, unit)
            assert n == len(widths) and m.restore(output, form) == text
            if form != "plain":
                ends = {0, *np.cumsum(widths).tolist()}
                assert prefix in ends and prefix + middle in ends


def test_broken_marks_at_the_cuts_are_restored():
    for text in ("<P", "<S<S", "a<M", "<<", "S>P>M>", "<P<S<M<P"):
        for doc_id in range(200):
            n, form, output, _, _ = m.arrange(text, doc_id)
            assert m.restore(output, form) == text
    assert m.arrange("has <S> in it", 1)[1] == "plain"


def plain(doc_id, text):
    """The contract, word by word."""
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    p, mid, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{mid}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{mid}"


def test_rows_follow_the_contract_and_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc é日\U0001f642<PSM>\n") for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(5, None), (5, None), (400, "")]
    got = m.digests(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert len(got) == len(rows)
    wanted = []
    for i, text in rows:
        form, a, b, output = plain(i, text or "")
        wanted.append((i, len(text or ""), form, a, b, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    clean = [tuple(None if v != v else v for v in r) for r in got.itertuples(index=False)]
    assert sorted(clean, key=repr) == sorted(wanted, key=repr) or sorted(map(str, [tuple(int(v) if isinstance(v, float) else v for v in r) for r in clean])) == sorted(map(str, wanted))
    con = duckdb.connect()
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    con.register("documents", documents)
    by_sql = con.execute(m.DOCUMENTS_SQL).fetchall()
    assert sorted(map(str, by_sql)) == sorted(map(str, wanted))


def test_hard_rows(spark):
    got = m.transform(hard.table(spark)).collect()
    assert len(got) == len(hard.rows())
    texts = {i: t or "" for i, t, *_ in hard.rows() if i is not None}
    for r in got:
        if r.doc_id is not None:
            assert m.restore(r.output, r.form) == texts[r.doc_id]
    assert m.transform(hard.empty(spark)).collect() == []
    only = spark.createDataFrame([(1,)], "doc_id long")
    assert [(r.n, r.form, r.output) for r in m.transform(only).collect()] == [(0, "plain", "")]
