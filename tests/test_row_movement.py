"""What wide rows carry while they are looked up, and what Spark knows of the size of the tables they are looked up in."""

from pyspark.sql import functions as F

from demandspark.operators.encoding import ENCODING_SPECS, FRAME, LABELLED, anchor_tables, bounded, encode_rows
from demandspark.plans.flagship import base_rows, build_features
from demandspark.session import cut_lineage
from tests.conftest import SF_SMALL


def _nodes(plan):
    yield plan
    kids = plan.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan()


def _output(node):
    out = node.output()
    return [(out.apply(i).name(), out.apply(i).dataType().typeName()) for i in range(out.size())]


def test_rows_carry_values_and_not_arrays_from_one_lookup_to_the_next(spark):
    rows = cut_lineage(base_rows(spark, SF_SMALL)[0])
    joins = [n for n in _nodes(_optimized(encode_rows(rows))) if n.nodeName() == "Join"]
    assert len(joins) == 4
    for j in joins:
        assert "array" not in {t for _, t in _output(j.children().apply(0))}


def test_the_table_that_categories_bound_has_a_size_of_its_own(spark):
    rows = cut_lineage(base_rows(spark, SF_SMALL)[0])
    specs = [s for s in ENCODING_SPECS if s.name in ("te__RoadType__mean", "te__geohash__hour__mean")]
    sizes = {bounded(a): _optimized(t).stats().sizeInBytes()
             for a, t in anchor_tables(rows.filter(F.col(FRAME) == LABELLED), specs)}
    assert set(sizes) == {True, False} and sizes[True] < sizes[False]


def test_features_that_follow_from_a_row_are_not_saved(spark):
    fr = build_features(spark, SF_SMALL)
    for df in (fr.train, fr.test):
        saved = {c for n in _nodes(_optimized(df)) if n.children().isEmpty() for c, _ in _output(n)}
        assert "te__geohash__mean" in saved and "timestamp" in saved
        assert not saved & {"sin_hour", "road_x_hour", "geohash_len", "temp_band"}
    assert {"sin_hour", "road_x_hour", "geohash_len", "temp_band", "gh_rank"} <= set(fr.train.columns)
