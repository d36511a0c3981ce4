from sorrel.operators import cells, query_log
from sorrel.sinks import cells as sink
from sorrel.plans import wide_cells
from sorrel.schemas import CELL_FAMILY


def test_null_cells_are_left_out_and_text_is_utf8(spark):
    df = spark.createDataFrame([("1", "é", 5), ("2", None, 6), (None, "x", 1)], "id string, b string, a int")
    got = sorted(tuple(r) for r in cells.to_cells(df, "id").collect())
    assert got == [("1", CELL_FAMILY, "a", "5"), ("1", CELL_FAMILY, "b", "é"), ("2", CELL_FAMILY, "a", "6")]
    raw = cells.as_bytes(cells.to_cells(df, "id")).where("value = encode('é', 'UTF-8')").head()
    assert bytes(raw["value"]) == "é".encode() and bytes(raw["rowkey"]) == b"1"


def test_single_column(spark):
    assert cells.to_cells(spark.createDataFrame([(1, 2)], "id int, only int"), "id").count() == 1


def test_bulk_files_are_sorted_and_do_not_overlap(spark, tmp_path):
    df = spark.range(500).selectExpr("cast(id * 7919 % 1000 as string) id", "id a", "id + 1 b")
    path = str(tmp_path / "bulk")
    for _ in range(2):
        sink.write_bulk(cells.to_cells(df, "id"), path, partitions=5)
    files = sorted((tmp_path / "bulk").glob("part-*.parquet"))
    spans, total = [], 0
    for file in files:
        keys = [(r["rowkey"], r["qualifier"]) for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)
        total += len(keys)
        if keys:
            spans.append((keys[0], keys[-1]))
    spans.sort()
    assert total == 1000 and len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_json_to_adopted_table(spark, tmp_path):
    source, target = tmp_path / "plants", str(tmp_path / "plant_cells")
    source.write_text('{"id":"fern","height":"40","shade":"yes"}\n{"id":"cactus","height":"15"}\n')
    wide_cells.bulk_load(spark, str(source), target, "plant_cells")
    wide_cells.bulk_load(spark, str(source), target, "plant_cells")
    try:
        assert spark.table("plant_cells").count() == 3
    finally:
        spark.sql("drop table plant_cells")


def file_clients(folder):
    """Clients that append each put to a file of their own; local, so that it ships with the task."""

    class FileClient:
        def __init__(self):
            import uuid

            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w", encoding="utf-8")

        def put(self, batch):
            text = "|".join(f"{bytes(c['rowkey']).decode()}:{bytes(c['qualifier']).decode()}" for c in batch)
            self.file.write(text + "\n")

        def close(self):
            self.file.close()

    return FileClient


def test_batches_of_puts(spark, tmp_path):
    df = spark.range(50).selectExpr("cast(id as string) id", "id a").coalesce(2)
    sink.put_batches(cells.as_bytes(cells.to_cells(df, "id")), file_clients(str(tmp_path)), batch=10)
    lines = [line for f in tmp_path.iterdir() for line in f.read_text().splitlines()]
    assert sorted(c for line in lines for c in line.split("|")) == sorted(f"{i}:a" for i in range(50))
    assert max(len(line.split("|")) for line in lines) == 10


def test_failed_put_fails_the_job(spark):
    class Broken:
        def put(self, batch):
            raise OSError("no connection")

        def close(self):
            pass

    df = spark.range(1).selectExpr("cast(id as string) id", "id a")
    try:
        sink.put_batches(cells.to_cells(df, "id"), Broken)
    except Exception as error:
        assert "no connection" in str(error)
    else:
        raise AssertionError("the failure was swallowed")


def test_direct_write_splits_families(spark, tmp_path):
    df = spark.range(3).selectExpr("cast(id as string) id", "id a")
    path = str(tmp_path / "direct")
    sink.write_direct(cells.to_cells(df, "id").unionByName(cells.to_cells(df, "id", "other")), path)
    assert sorted(p.name for p in (tmp_path / "direct").glob("family=*")) == [f"family={CELL_FAMILY}", "family=other"]


def log(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "q int, sql string")


CATALOGUE = [("boats", c) for c in ("hull", "mast", "length")] + [("crews", c) for c in ("boat_id", "size")]


def test_tables_of_statements(spark):
    df = log(
        spark, "select b.hull from boats b join crews c on b.mast = c.boat_id join boats x on x.hull = b.hull",
        "SELECT *\nFROM port1.boats\nWHERE length > 9", "select a from t1 as x JOIN db2.t2 on x.a = t2.a", "select 1",
        "select hull from boats where mast = 'from crews, ports'",
    )
    got = sorted((r["q"], r["database"] or "", r["table"]) for r in query_log.tables(df, "q", "sql").collect())
    assert got == [
        (0, "", "boats"), (0, "", "crews"), (1, "port1", "boats"), (2, "", "t1"), (2, "db2", "t2"), (4, "", "boats"),
    ]


def test_statements_that_are_only_flagged(spark):
    df = log(
        spark, "select x from t x, u y", "select x from s.d.t", "with w as (select 1) select * from w", "select x from `t`",
        "select hull from (select hull from boats) t", "select hull from boats union select size from crews", None,
        "select x from t join \"u\" on 1 = 1", "delete from boats",
    )
    catalogue = spark.createDataFrame(CATALOGUE, "table string, column string")
    for found in (query_log.tables(df, "q", "sql"), query_log.selected_columns(df, "q", "sql", catalogue)):
        assert sorted((r["q"], r["table"], r["unsupported"]) for r in found.collect()) == [(q, None, True) for q in range(9)]


def test_selected_columns(spark):
    df = log(
        spark,
        "select size, upper(b.hull) as text from crews c right join boats b on b.mast = c.boat_id",
        "select * from port1.crews",
        "select c.* from boats b join crews c on b.mast = c.boat_id where b.length > 3",
        "select max(mast) as hull, 'length' from boats",
        "select missing from boats",
        "select count(*) from boats",
        "select length * 2 as twice, b.length*b.mast from boats b",
        "select distinct *, size from crews",
    )
    catalogue = spark.createDataFrame(CATALOGUE, "table string, column string")
    found = query_log.selected_columns(df, "q", "sql", catalogue).collect()
    assert not any(r["unsupported"] for r in found)
    assert sorted((r["q"], r["table"], r["column"]) for r in found) == [
        (0, "boats", "hull"), (0, "crews", "size"), (1, "crews", "boat_id"), (1, "crews", "size"),
        (2, "crews", "boat_id"), (2, "crews", "size"), (3, "boats", "mast"), (6, "boats", "length"), (6, "boats", "mast"),
        (7, "crews", "boat_id"), (7, "crews", "size"),
    ]


def test_joins_without_on_comments_and_inner_froms(spark):
    df = log(
        spark, "select b.hull from crews join boats b using (mast)", "select b.hull, size from boats b natural join crews",
        "select extract(year from hull) from boats", "select hull from boats where hull is distinct from mast",
        "select hull -- , mast\nfrom boats -- join crews\nwhere mast = '--' and length > 1 /* from crews */",
        "select substring(hull from 2) from boats", "select hull from boats left outer join crews on mast = size for update",
        "select b.hull from boats tablesample (5 rows) b",
    )
    got = sorted((r["q"], r["table"] or "", r["unsupported"]) for r in query_log.tables(df, "q", "sql").collect())
    assert got == [
        (0, "boats", False), (0, "crews", False), (1, "boats", False), (1, "crews", False), (2, "", True), (3, "", True),
        (4, "boats", False), (5, "", True), (6, "boats", False), (6, "crews", False), (7, "", True),
    ]
    catalogue = spark.createDataFrame(CATALOGUE, "table string, column string")
    found = query_log.selected_columns(df, "q", "sql", catalogue).where("not unsupported").collect()
    assert sorted((r["q"], r["table"], r["column"]) for r in found) == [
        (0, "boats", "hull"), (1, "boats", "hull"), (1, "crews", "size"), (4, "boats", "hull"), (6, "boats", "hull"),
    ]


def test_names_of_a_log_need_no_shuffle(spark, capsys):
    query_log.tables(log(spark, "select a from t"), "q", "sql").explain()
    assert "Exchange" not in capsys.readouterr().out


def test_ddl_text(spark):
    rows = [("boats", 1, "mast", "string"), ("boats", 0, "hull", "string"), ("crews", 0, "size", "int")]
    df = spark.createDataFrame(rows, "table string, position int, column string, type string")
    assert {r["ddl"] for r in query_log.ddl(df).collect()} == {
        "create table boats (  hull  string,mast  string  );", "create table crews (  size  int  );",
    }
