"""Large groups of copies in op7, and stages on tables whose columns have the operators' own names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revaudit.llm import mixing, near_duplicates
from revaudit.llm.tables import ship_package, unused


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _rows() -> dict[int, str | None]:
    """Half of the rows are copies of one text, some are near it, the others differ; a tenth is empty."""
    words = [f"w{k}" for k in range(60)]
    rows: dict[int, str | None] = {10 + k: " ".join(words) for k in range(150)}
    for k in range(20):
        near = list(words)
        near[k] = f"x{k}"
        rows[500 + k] = " ".join(near)
    rows |= {700 + k: " ".join(f"t{k}-{i}" for i in range(3 + k % 40)) for k in range(100)}
    rows |= {900 + k: ("", None, " \n")[k % 3] for k in range(30)}
    return rows


def test_hot_classes_equal_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == near_duplicates.brute_force(rows)


def test_repeated_ids_link_what_any_of_their_rows_links(spark):
    """Id 3 has a copy of the hot text and one of another group: both groups are one."""
    rows = _rows()
    other = " ".join(f"o{k}" for k in range(30))
    listed = [*rows.items(), (3, rows[10]), (3, other), (1000, other), (1001, other), (1001, other)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(listed, "doc_id long, text string")).collect()
    assert len(got) == len(listed)
    component = {r.doc_id: r.component_id for r in got}
    assert {component[d] for d in (3, 10, 159, 500, 1000, 1001)} == {3} and component[700] == 700


def test_rows_of_hot_classes_are_not_shuffled_to_their_class(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 700, 1).otherwise(F.col("id")).cast("long").alias("f1"),
                                    F.lit(5).cast("long").alias("f2"))
    classes = rows.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    got = near_duplicates.class_values(rows, classes, "id", 100)
    assert {r.doc_id: r.id for r in got.collect()} == {k: 0 if k < 700 else k for k in range(1000)}
    without = near_duplicates.class_values(rows, classes.where("f1 <> 800"), "id", 100)
    assert [r.doc_id for r in without.where("id IS NULL").collect()] == [800] and without.count() == 1000
    # 700 of 1,000 rows are of one class: the shuffled part holds the other 300.
    cold = rows.join(F.broadcast(classes.where("n > 100").select("f1", "f2")), ["f1", "f2"], "left_anti")
    assert cold.count() == 300


def test_unused_names():
    assert unused(["a", "Gone_ID", "gone_id_"], "gone_id") == "gone_id__" and unused([], "x") == "x"


def test_stages_keep_columns_with_the_operators_own_names(spark):
    text = "a b c d e f g h"
    listed = [(k, text if k < 4 else f"{text} {k} {k} {k} {k} {k} {k}", "s", -k, f"x{k}", True, "t", 1.5, k) for k in range(1, 9)]
    names = "doc_id long, text string, source string, GONE_ID int, m_doc string, m_t boolean, m_n string, m_i double, `component.id` int"
    docs = spark.createDataFrame(listed, names)
    kept = near_duplicates.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(r for r in listed if r[0] not in (2, 3))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= set(listed) and mixed.count() > 0


def test_one_row_stays_of_repeated_rows_and_of_rows_without_an_id(spark):
    a, b, c = ("a b c d e f g h", "k l m n o p q r", "s t u v w x y z")
    listed = [(1, a, "s"), (1, a, "s"), (1, a, "r"),           # repeated: one stays, the least as JSON
              (2, b, "s"), (2, c, "s"), (2, c, "s"),           # two texts under one id: both stay, once
              (3, a, "s"), (3, a, "s"),                        # copies of 1: all go
              (4, "", "s"), (4, "", "s"), (5, None, "s"), (5, None, "s"), (6, " ", "s"),
              (None, b, "s"), (None, b, "s"), (None, b, None), (None, c, "q"),
              (None, "", "s"), (None, "", "s"), (None, None, "s"), (None, None, "s"), (7, "alone", None)]
    docs = spark.createDataFrame(listed, "doc_id long, text string, source string").repartition(5)
    want = [(1, a, "r"), (2, b, "s"), (2, c, "s"), (4, "", "s"), (5, None, "s"), (6, " ", "s"), (None, b, "s"), (None, c, "q"),
            (None, "", "s"), (None, "", "s"), (None, None, "s"), (None, None, "s"), (7, "alone", None)]
    kept = near_duplicates.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("columns", ["doc_id long, text string", "doc_id long, text string, k0 string, first map<string, int>"])
def test_keep_first_of_a_hot_id_and_of_an_empty_table(spark, columns):
    more = ("x", {"a": 1}) if "map" in columns else ()
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text, *more)] * 50 + [(None, text, *more)] * 50 + [(k, f"{k} {k}", *more) for k in range(2, 5)], columns)
    assert sorted(r.doc_id or 0 for r in near_duplicates.keep_first(docs).collect()) == [0, 1, 2, 3, 4]
    assert near_duplicates.keep_first(docs.limit(0)).collect() == []
