import random

import pyarrow as pa
import pytest

from poolwright.llm import decontaminate as m
from poolwright.llm.common import utf8
from tests.llm import hard


def word(rng):
    return "".join(rng.choice(["ba", "du", "ki", "lo", "st", "re"]) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def distance(item, text):
    """Fewest edits to some part of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        a, t = ("".join(rng.choice("abc ") for _ in range(rng.randint(lo, hi))) for lo, hi in ((1, 20), (0, 40)))
        assert m.edit_distance_within(a, t, 99) == distance(a, t)


def edited(rng, item, share):
    words = item.split()
    for _ in range(int(share * len(words))):
        k, how = rng.randrange(len(words)), rng.random()
        if how < 0.5:
            words[k] = word(rng)
        elif how < 0.75 and len(words) > 6:
            del words[k]
        else:
            words.insert(k, word(rng))
    return " ".join(words)


def test_recall_against_exact_distances(spark):
    """Of all items within 0.8 of a part of a document nine in ten are found, and nothing else."""
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(12, 60))) for i in range(40)]
    docs = []
    for i in range(160):
        share = (i % 5) * 0.04
        docs.append((i, prose(rng, rng.randint(0, 80)) + ". " + edited(rng, items[i % 40][1], share).upper() + "! " + prose(rng, rng.randint(0, 80))))
    docs += [(1000 + i, prose(rng, 150)) for i in range(40)]
    index = m.Index(items, 0.8)
    wanted = set()
    for i, t in docs:
        words = m.Words(*utf8(pa.array([t])))
        plain = words.text(0, len(words.hashes))
        wanted |= {(i, index.ids[k]) for k, item in enumerate(index.texts) if m.edit_distance_within(item, plain, index.most[k]) is not None}
    got = m.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= wanted and not any(i >= 1000 for i, _ in found)
    assert len(found) >= 0.95 * len(wanted) and len(wanted) > 120
    exact = {(r.doc_id, r.item_id) for r in got if r.edits == 0}
    assert {(i, i % 40) for i in range(0, 160, 5)} <= exact
    for r in got:
        part = dict(docs)[r.doc_id].encode()[r.first_byte : r.last_byte].decode()
        assert part and r.similarity >= 0.8


@pytest.mark.parametrize("most", [1 << 20, 600])
def test_blocks_of_items_find_the_same(spark, monkeypatch, most):
    monkeypatch.setattr(m, "PASS_BYTES", most)
    rng = random.Random(3)
    items = [(i, prose(rng, 20)) for i in range(30)] + [(None, prose(rng, 20)), (77, None), (78, ""), (79, "two words")]
    docs = [(i, prose(rng, 30) + " " + items[i % 31][1]) for i in range(62)] + [(100, "two words")]
    docs_df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in m.contaminated(docs_df, items_df).collect()}
    assert got == {(i, i % 31 if i % 31 < 30 else -1) for i in range(62)}
    assert [r.doc_id for r in m.clean(docs_df, items_df).collect()] == [100]


def test_short_items_and_scripts_without_spaces(spark):
    items = [(1, "水在标准大气压下的沸点是多少摄氏度"), (2, "Name the largest planet"), (3, "人工智能"), (4, "ภาษาไทยไม่มีช่องว่าง")]
    docs = [
        (1, "问题：水在标准大气压下的沸点是多少摄氏度？答案是一百。"), (2, "so, name the LARGEST planet!"), (3, "我们研究人工智能的历史"), (4, "อ่านภาษาไทยไม่มีช่องว่างเลย"),
        (5, "我们去北京看朋友，然后在家里吃饭。"), (6, "name the planet largest"), (7, "水在标准大气圧下的沸点是多少摄氏度"), (8, "name the largest planetary ring")]
    docs_df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in m.contaminated(docs_df, items_df).collect()}
    assert {i: (r.item_id, r.edits) for i, r in got.items()} == {1: (1, 0), 2: (2, 0), 3: (3, 0), 4: (4, 0), 7: (1, 1)}
    assert docs[1][1].encode()[got[2].first_byte : got[2].last_byte].decode() == "name the LARGEST planet"
    assert sorted(r.doc_id for r in m.clean(docs_df, items_df).collect()) == [5, 6, 8]


def test_hard_rows(spark):
    rng = random.Random(4)
    item = hard.rows()[0][1].split()
    items = spark.createDataFrame([(1, " ".join(item[20:50])), (2, prose(rng, 30)), (3, None)], "item_id long, text string")
    docs = hard.table(spark)
    got = m.contaminated(docs, items).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(["1", "2", "3", "3", "None", "14"][:6]) and {r.item_id for r in got} == {1}
    kept = m.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(got)
    assert m.contaminated(hard.empty(spark), items).collect() == [] and m.clean(hard.empty(spark), items).collect() == []
    assert m.contaminated(docs, items.filter("false")).collect() == [] and m.clean(docs, items.filter("false")).count() == docs.count()


def test_short_items_with_edits_against_exact_distances(spark):
    """Whatever their length, items of few words are found with as many edits as longer ones."""
    rng = random.Random(6)
    short = lambda: " ".join("".join(rng.choice("abcdeé水") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 4)))
    items = [(i, short()) for i in range(60)] + [(90, "two words"), (91, "Name the largest planet"), (92, "yes"), (93, "x" * 70 + " " + "yz" * 20)]
    docs = [(100, "Two wirds"), (101, "so, name the LARGST planet!"), (102, "yes."), (103, "yesterday"), (104, "namethe largest planet"), (105, "x" * 60 + " " + "yz" * 21), (106, None), (107, "")]
    docs += [(i, " ".join(short() for _ in range(6))) for i in range(80)]
    index = m.Index(items, 0.8, whole=True)
    wanted = {}
    for i, t in docs:
        words = m.Words(*utf8(pa.array([t], pa.string())))
        plain = words.text(0, len(words.hashes))
        for k, item in enumerate(index.texts):
            if index.most[k]:
                edits = m.edit_distance_within(item, plain, index.most[k])
                if edits is not None:
                    wanted[i, index.ids[k]] = edits
            else:
                own, all_ = m.Words(*utf8(pa.array([item]))).hashes.tolist(), words.hashes.tolist()
                if any(all_[a : a + len(own)] == own for a in range(len(all_))):
                    wanted[i, index.ids[k]] = 0
    docs_df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = m.contaminated(docs_df, items_df, whole=True).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in got} == wanted and len(wanted) > 60 and len(got) == len(wanted)
    assert {(100, 90): 1, (101, 91): 1, (102, 92): 0, (104, 91): 1}.items() <= wanted.items() and (105, 93) in wanted and (103, 92) not in wanted
    place = {(r.doc_id, r.item_id): dict(docs)[r.doc_id].encode()[r.first_byte : r.last_byte].decode() for r in got}
    assert place[100, 90] == "Two wirds" and place[101, 91] == "name the LARGST planet" and place[104, 91] == "namethe largest planet"
    assert {r.doc_id for r in m.clean(docs_df, items_df, whole=True).collect()} == {i for i, _ in docs} - {i for i, _ in wanted}
