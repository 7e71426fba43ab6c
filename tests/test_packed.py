"""Splitting packed fields: delimiters, quotes, offsets, learned commas, odd inputs."""

from pyspark.sql import functions as F

from newsloom.operators.packed import LOCATIONS, ORGANIZATIONS, PERSONS, THEMES, Packed, explode_values, unpack_values


def values(spark, rows, spec):
    df = spark.createDataFrame(rows, f"doc_id long, {spec.name} string")
    return {r.doc_id: r["values"] for r in unpack_values(df, [spec]).collect()}


def test_delimiters_quotes_and_offsets(spark):
    got = values(
        spark,
        [(1, "A_X,12;B_Y, 30 ; ;C_Z|\nD_Q,5;;"), (2, "A_X,B_Y, C_Z"), (3, '"A_X",1;"B""Y",2'), (4, "  "), (5, None), (6, ";;|"), (7, '"A_X","B_Y"'), (8, "77")],
        THEMES,
    )
    assert got == {1: ["A_X", "B_Y", "C_Z", "D_Q"], 2: ["A_X", "B_Y", "C_Z"], 3: ["A_X", 'B"Y'], 7: ["A_X", "B_Y"], 8: ["77"]}


def test_locations_take_the_name(spark):
    got = values(spark, [(1, '4#Oldtown, Land#LA#LA01#1.5#-2.0#-100;1#Land#LA#LA#1#2#LA'), (2, '"4#Port; Outer Ward, Land#LA#LA1#1#2#3"\n"4#North | South#LA#LA2#1#2#3"')], LOCATIONS)
    assert got == {1: ["Oldtown, Land", "Land"], 2: ["Port; Outer Ward, Land", "North | South"]}


def test_quoted_after_a_line_break(spark):
    assert values(spark, [(1, 'Ann Lee\n"Bo; Sons"\t"C ""D"" E"')], PERSONS)[1] == ["Ann Lee", "Bo; Sons", 'C "D" E']


def test_learned_commas(spark):
    """Names keep their comma, lists without offsets are cut where the parts are values elsewhere."""
    rows = [(k, "Alpha Works,10;Beta Mills,25;Gamma Yard,40") for k in range(30)]
    rows += [(100 + k, "Delta, Timber and Partners,12") for k in range(5)]
    rows += [(200, "Delta, Timber and Partners"), (201, "Alpha Works, Beta Mills, Gamma Yard"), (202, "Beta Mills,Gamma Yard")]
    got = values(spark, rows, ORGANIZATIONS)
    assert got[100] == got[200] == ["Delta, Timber and Partners"]
    assert got[201] == ["Alpha Works", "Beta Mills", "Gamma Yard"]
    assert got[202] == ["Beta Mills", "Gamma Yard"]


def test_rows_repeats_positions_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "A;B", "x"), (1, "A;B", "x"), (None, "C", "y")], "doc_id long, v2_themes string, field string").withColumn("values", F.lit(1)).withColumn("pos", F.lit(2))
    assert sorted(map(tuple, explode_values(df, [THEMES]).collect())) == [(1, "v2_themes", 1, "A"), (1, "v2_themes", 2, "B")]


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], "doc_id long, v2_persons string")
    assert explode_values(empty, [PERSONS]).count() == 0
    long = ";".join(f"Name {k},{k}" for k in range(20_000))
    df = spark.createDataFrame([(1, long), (2, "x" * 300_000), (3, '"' * 5001)], "doc_id long, v2_persons string")
    got = {r.doc_id: len(r["values"]) for r in unpack_values(df, [PERSONS]).collect()}
    assert got[1] == 20_000 and got[2] == 1 and got[3] == 1


def test_other_field_names(spark):
    assert values(spark, [(1, "a,b|c")], Packed("tags", inner_comma=False)) == {1: ["a", "b", "c"]}
