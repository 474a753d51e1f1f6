import gzip
import hashlib
import random
from pathlib import Path

import pytest

from poolwright.llm import warc as m

SCHEMA = "page_id long, url string, html string, digest string, shard int"


def pages():
    rng = random.Random(1)
    big = ["".join(rng.choice("abc<>é\n") for _ in range(rng.randint(1000, 4000))) for _ in range(12)]
    rows = [(i, f"http://h/{i}\r\nX: 1%", rng.choice(big)) for i in rng.sample(range(1000), 150)]
    rows += [(5000, None, None), (5001, "u", ""), (5002, "u", "x" * 999), (5003, "u", "x" * 999), (5004, "u", "y" * 1000), (5005, "u", "y" * 1000)]
    rows += [(None, "n", big[0]), (None, "n", big[0]), (None, None, None), rows[0], (5005, "u", "y" * 1000), (6000, "u", "z\r\n\r\n" * 300_000)]
    return [(*r, "d", 7) for r in rows]


def wanted(rows):
    kept = {}
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            kept[b] = max(kept.get(b, i), i)
    out = []
    for i, u, h, *_ in rows:
        b = (h or "").encode()
        refers = kept.get(b) if len(b) >= 1000 and kept.get(b) != i else None
        out.append((i, u, "revisit" if refers is not None else "response", refers, len(b), hashlib.sha1(b).hexdigest(), None if refers is not None else b))
    return sorted(out, key=str)


@pytest.mark.parametrize(("roll", "shard"), [(1 << 20, 1 << 20), (3000, 20_000)])
def test_archives_come_back(spark, tmp_path, roll, shard):
    rows = pages()
    manifest = m.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"), roll, shard).collect()
    got = m.read(spark, str(tmp_path / "a")).collect()
    assert sorted(((*tuple(r)[:6], None if r.payload is None else bytes(r.payload)) for r in got), key=str) == wanted(rows)
    files = sorted((tmp_path / "a").glob("*.warc.gz"))
    assert sorted(r.name for r in manifest) == [f.name for f in files] and not (tmp_path / "a/temporary").exists()
    assert sum(r.records for r in manifest) == len(rows) and (roll > 3000) == (len(files) < 5)
    for r in manifest:
        raw = (tmp_path / "a" / r.name).read_bytes()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (r.bytes, r.sha256)
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and b"\r\nWARC-Type: warcinfo\r\n" in text


def test_files_are_the_same_for_any_order_and_partitioning(spark, tmp_path):
    rows = pages()
    m.write(spark.createDataFrame(rows, SCHEMA).repartition(7), str(tmp_path / "a"), 3000, 20_000)
    m.write(spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1), str(tmp_path / "b"), 3000, 20_000)
    a, b = ({f.name: f.read_bytes() for f in (tmp_path / x).glob("*.warc.gz")} for x in "ab")
    assert a == b and len(a) > 5


@pytest.mark.parametrize("far", [5, 10**6, 10**12, 2**63 - 1])
def test_an_id_far_off_does_not_fill_a_shard(spark, far):
    """Shards stay near their size wherever ids lie, and none is cut within an id."""
    rows = [(i, "h" * 99) for i in range(1000)] + [(far, "h" * 99), (-far - 1, "h" * 99), (None, "h" * 99), (7, "h" * 30_000)]
    begins = m.edges(spark.createDataFrame(rows, "page_id long, html string"), 10_000)
    assert begins == sorted(set(begins))
    sizes = {}
    for i, h in rows:
        k = 0 if i is None else sum(b <= i for b in begins)
        sizes.setdefault(k, []).append((i, len(h) + 1))
    assert all(sum(n for _, n in v) <= 10_000 or {i for i, n in v if n > 30_000} == {7} for v in sizes.values())
    assert len(sizes) == len(begins) + 1 and 10 < len(sizes) < 30
    cut = spark.createDataFrame([(i,) for i in begins], "i long").select(m.range_of(m.F.array(*[m.F.lit(b) for b in begins]), m.F.col("i"))).collect()
    assert [r[0] for r in cut] == list(range(1, len(begins) + 1))


def test_ranges_of_ids_follow_each_other(spark, tmp_path):
    manifest = m.write(spark.createDataFrame(pages(), SCHEMA), str(tmp_path / "a"), 3000, 20_000).collect()
    last = -1
    for r in sorted(manifest, key=lambda r: (r.shard, r.number)):
        with Path(tmp_path / "a" / r.name).open("rb") as f:
            ids = [int(x["warc-page-id"]) for x, _ in m.records(f) if "warc-page-id" in x]
        assert ids == sorted(ids) and (not ids or ids[0] >= last)
        last = ids[-1] if ids else last


def test_commit_may_be_repeated_and_ignores_strays(spark, tmp_path):
    folder = str(tmp_path / "a")
    m.write(spark.createDataFrame(pages(), SCHEMA), folder)
    (tmp_path / "a/temporary").mkdir()
    (tmp_path / "a/temporary/0-0-lost").write_bytes(b"half a record")
    m.commit(spark, folder)
    assert m.read(spark, folder).count() == len(pages())


def test_a_wrong_payload_is_noticed(spark, tmp_path):
    m.write(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), str(tmp_path / "a"))
    name = next((tmp_path / "a").glob("*.warc.gz"))
    good = name.read_bytes()
    name.write_bytes(m.first_member(name.name) + m.page_member(1, "u", b"abc", None)[:-40])
    with pytest.raises(Exception, match="within a record"):
        m.read(spark, str(tmp_path / "a")).collect()
    name.write_bytes(good)


def test_no_pages(spark, tmp_path):
    m.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"))
    assert m.read(spark, str(tmp_path / "a")).collect() == []
