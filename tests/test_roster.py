import json

from pyspark.sql import functions as F

from postwave.operators.ranking import global_position
from postwave.operators.rules import roster_rules
from postwave.sources import roster

HEADER = "screen_name;user_id;name;party;location;created_at"


def lines(spark, rows):
    return spark.createDataFrame(rows, "version int, value string")


def test_load_trims_and_drops_short_rows(spark):
    df = lines(spark, [(1, " alice ;\t1 ;Alice;A;Berlin;2020 \r"), (1, "bob;2;Bob;B;Bonn"),
                       (1, "carl;3;Carl;C;Köln;2019;extra")])
    got = roster.load_roster(df).orderBy("user_id").collect()
    assert [(r["screen_name"], r["user_id"], r["created_at"]) for r in got] == [("alice", "1", "2020"),
                                                                              ("carl", "3", "2019")]
    assert [r["reason"] for r in roster.roster_rejects(df).collect()] == ["too_few_cells"]


def test_later_version_wins(spark):
    df = lines(spark, [(1, "a;1;A;X;l;c"), (2, "a2;1;A;Y;l;c"), (1, "b;2;B;X;l;c")])
    got = {r["user_id"]: r["party"] for r in roster.dedup_roster(roster.load_roster(df)).collect()}
    assert got == {"1": "Y", "2": "X"}


def test_global_position_matches_row_number(spark):
    df = spark.range(0, 1000).select(F.format_string("u%04d", (F.col("id") * 7919) % 1000).alias("k"))
    pos = global_position(df, ["k"], n_parts=5).orderBy("k").collect()
    assert [r["position"] for r in pos] == list(range(1000))


def test_rules_text_and_chunks(spark):
    rows = [(f"name{i}", f"{i:03d}") for i in range(41)]
    df = spark.createDataFrame(rows, "screen_name string, user_id string")
    rules = roster_rules(df, chunk_size=20).orderBy("chunk").collect()
    assert [r["n_accounts"] for r in rules] == [20, 20, 1]
    first = rules[0]["rule"]
    assert first.startswith('{ "add": [ { "value": "from:name0 OR from:name1 OR ')
    assert first.endswith(' lang:de -is:retweet","tag": "MdBList1"}]}')
    parsed = json.loads(rules[2]["rule"])
    assert parsed == {"add": [{"value": "from:name40 lang:de -is:retweet", "tag": "MdBList3"}]}


def test_read_roster_files_later_file_wins(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/r")
    with open(f"{tmp_dir}/r/a_2020.csv", "w") as f:
        f.write(HEADER + "\nann;1;Ann;X;Bonn;2019\nben;2;Ben;Y;Ulm;2019\nshort;3;Short;Z;Kiel\n")
    with open(f"{tmp_dir}/r/b_2021.csv", "w") as f:
        f.write("Screenname;ID;Name;Partei;Ort;Datum\r\n\tann\t;1;Ann;W;Bonn;2021\r\n")
    got = {r["user_id"]: r["party"] for r in roster.read_roster(spark, f"{tmp_dir}/r").collect()}
    assert got == {"1": "W", "2": "Y"}
    rules = roster_rules(roster.read_roster(spark, f"{tmp_dir}/r"), chunk_size=20).collect()
    assert json.loads(rules[0]["rule"])["add"][0]["value"] == "from:ann OR from:ben lang:de -is:retweet"


def test_global_position_with_ties(spark):
    df = spark.range(0, 600).select((F.col("id") % 3).cast("string").alias("k"), F.col("id"))
    pos = global_position(df, ["k"], n_parts=4).collect()
    assert sorted(r["position"] for r in pos) == list(range(600))
    by_pos = sorted(pos, key=lambda r: r["position"])
    assert [r["k"] for r in by_pos] == sorted(r["k"] for r in pos)


def test_hot_key_spreads_over_partitions(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
                                     .alias("k"), F.col("id"))
    pos = global_position(df, ["k"], n_parts=6)
    sizes = [r["n"] for r in pos.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 1000          # the 1,000 "hot" rows do not sit in one partition
    assert sorted(r["position"] for r in pos.collect()) == list(range(3000))


def test_later_line_wins_over_many_splits(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/r")
    lines = [f"name{i};{i % 97};N{i};P{(i * 7919) % 1000};Ort;2020" for i in range(2000)]
    for name, part in (("a.csv", lines[:1200]), ("b.csv", lines[1200:])):
        with open(f"{tmp_dir}/r/{name}", "w") as f:
            f.write("\n".join([HEADER, *part]) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r["user_id"]: r["screen_name"] for r in roster.read_roster(spark, f"{tmp_dir}/r").collect()}
        assert got == {str(i % 97): f"name{i}" for i in range(2000)}
        read = roster.read_roster_lines(spark, f"{tmp_dir}/r")
        assert read.rdd.getNumPartitions() > 10
        numbers = {r["value"].split(";")[0]: r["line"] for r in roster.line_numbers(read).collect()}
        assert numbers == {f"name{i}": (i if i < 1200 else i - 1200) + 1 for i in range(2000)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
