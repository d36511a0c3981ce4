import datetime
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from sorrel import schemas
from sorrel.operators import behaviour
from sorrel.plans import collaborative, content, location
from sorrel.sinks import jdbc, kafka
from sorrel.sources import excel, files, streams


def test_items_are_trimmed_and_bad_lines_flagged(spark, tmp_path):
    path = tmp_path / "items.txt"
    path.write_text(" 1 , north , here , 3 , 1 , 0 , 2500.5 , 1 \n2,south,there,4,2,1,100,0\n3,short\n4,odd,x,notanumber,1,1,1,1\n")
    rows = {r["schoolid"]: r for r in files.items(spark, str(path)).collect()}
    assert rows[1]["schoolname"] == "north" and rows[1]["fee"] == 2500.5 and rows[1]["_corrupt"] is None
    assert rows[3]["_corrupt"] is not None and rows[4]["_corrupt"] is not None
    shaped = content.with_features(files.items(spark, str(path)).where("schoolid = 2")).head()
    assert shaped["features"] == [4.0, 2.0, 1.0, 100.0, 0.0]


def test_names_keep_their_blanks(spark, tmp_path):
    path = tmp_path / "names.txt"
    path.write_text("1, a \n2,b\n")
    assert [(r["item_id"], r["name"]) for r in files.item_names(spark, str(path)).orderBy("item_id").collect()] == [(1, " a "), (2, "b")]


def test_behaviour_log(spark, tmp_path):
    path = tmp_path / "log.txt"
    path.write_text("1,浏览,5\nbad\n1,收藏,5\n", encoding="utf-8")
    ratings = collaborative.ratings_from_behaviours(spark, str(path)).collect()
    assert [(r["user_id"], r["item_id"], round(r["score"], 9)) for r in ratings] == [(1, 5, 2.7)]
    assert behaviour.rejected(files.behaviours(spark, str(path))).count() == 1


def test_location_job_from_pipe_files(spark, tmp_path):
    ranges, log = tmp_path / "ip.txt", tmp_path / "log"
    line = "x|y|{}|{}|4|5|Asia|CN|8|JS|10|11|12|320500|CN2|15\n"
    ranges.write_text(line.format(22429696, 22429951) + line.format("bad", 5) + "short|line\n")
    log.write_text("t|1.86.64.0|u\nt|1.86.64.255|u\nt|9.9.9.9|u\nnofields\n")
    counts = location.count_locations(spark, str(log), str(ranges)).collect()
    assert [tuple(r) for r in counts] == [("Asia-CN-JS-320500-CN2", 2)]


def test_json_with_and_without_schema(spark, tmp_path):
    path = tmp_path / "stats"
    path.write_text('{"id":"k9","url":"shop.test/cart","pv":37,"uv":12}\n')
    assert files.json_table(spark, str(path)).dtypes == files.json_table(spark, str(path), schemas.STATS).select(
        "id", "pv", "url", "uv"
    ).dtypes


def workbook(path, rows, shared):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'

    def cell(at, value):
        if isinstance(value, str) and value in shared:
            return f'<c r="{at}" t="s"><v>{shared.index(value)}</v></c>'
        if isinstance(value, str):
            return f'<c r="{at}" t="inlineStr"><is><t>{value}</t></is></c>'
        return f'<c r="{at}"><v>{value}</v></c>'

    body = "".join(
        f'<row r="{n}">' + "".join(cell(f"{'ABC'[i]}{n}", v) for i, v in enumerate(row) if v is not None) + "</row>"
        for n, row in enumerate(rows, 1)
    )
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")


def test_folder_of_workbooks(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [("id", "name", "fee"), (1, "north", 2.5), (2, None, 3)], ["id", "name", "fee", "north"])
    workbook(tmp_path / "b.xlsx", [("name", "id"), ("é", 7), ("x", "no")], ["name"])
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("fee", DoubleType())])
    got = sorted((tuple(r) for r in excel.workbooks(spark, str(tmp_path), schema).collect()), key=repr)
    assert got == sorted([(1, "north", 2.5), (2, None, 3.0), (7, "é", None), (None, "x", None)], key=repr)


def test_cell_types_and_the_first_sheet_of_the_workbook(spark, tmp_path):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = f"""<worksheet xmlns="{main}"><sheetData>
      <row r="1">{''.join(f'<c r="{c}1" t="inlineStr"><is><t>{n}</t></is></c>' for c, n in zip("ABCDE", ("id", "open", "day", "at", "bad")))}</row>
      <row r="2"><c r="A2"><v>1</v></c><c r="B2" t="b"><v>1</v></c><c r="C2"><v>45000</v></c><c r="D2"><v>45000.75</v></c><c r="E2" t="e"><v>#DIV/0!</v></c></row>
      <row r="3"><c r="A3"><v>2</v></c><c r="B3" t="b"><v>0</v></c><c r="C3" t="inlineStr"><is><t>2024-02-03</t></is></c></row></sheetData></worksheet>"""
    for name, late in (("a", ""), ("b", '<workbookPr date1904="1"/>')):
        with zipfile.ZipFile(tmp_path / f"{name}.xlsx", "w") as book:
            book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}">{late}<sheets><sheet name="x" r:id="r2"/><sheet name="y" r:id="r1"/></sheets></workbook>')
            book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/>'
                          '<Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
            book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
            book.writestr("xl/worksheets/sheet2.xml", sheet)
    kinds = (("id", IntegerType()), ("open", BooleanType()), ("day", DateType()), ("at", TimestampType()), ("bad", StringType()))
    rows = excel.workbooks(spark, str(tmp_path), StructType([StructField(n, k) for n, k in kinds])).withColumn("at", F.col("at").cast("string"))
    day = datetime.date
    assert sorted((tuple(r) for r in rows.collect()), key=str) == [
        (1, True, day(2023, 3, 15), "2023-03-15 18:00:00", None), (1, True, day(2027, 3, 16), "2027-03-16 18:00:00", None),
        (2, False, day(2024, 2, 3), None, None), (2, False, day(2024, 2, 3), None, None),
    ]


def test_unreadable_ranges_and_log_lines_come_out(spark, tmp_path):
    line = lambda a, b: f"x|x|{a}|{b}|x|x|c|p|x|t|x|x|x|d|i"
    ranges, log = tmp_path / "ranges.txt", tmp_path / "log.txt"
    ranges.write_text("\n".join([line(1, 9), line("a", 9), line(1, ""), line(9, 1), line(1, 2**32), "short"]) + "\n")
    log.write_text("x|1.2.3.4\nx|300.1.1.1\nx\n")
    assert [tuple(r) for r in files.ip_ranges(spark, str(ranges)).collect()] == [(1, 9, "c-p-t-d-i")]
    assert sorted(r["reject_reason"] for r in files.rejected_ip_ranges(spark, str(ranges)).collect()) == ["end", "outside", "reversed", "start", "start"]
    assert sorted(tuple(r) for r in files.rejected_log_lines(spark, str(log)).collect()) == [("x", "arity"), ("x|300.1.1.1", "address")]


def test_kafka_options():
    options = streams.kafka_options("h:1", ["t1", "t2"], reset="smallest", consumer_threads=2)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t1,t2", "startingOffsets": "earliest", "failOnDataLoss": "true",
        "minPartitions": "2",
    }
    limited = streams.kafka_options("h:1", ["t"], max_offsets=streams.DIRECT_OFFSETS, fail_on_data_loss=False)
    assert limited["maxOffsetsPerTrigger"] == "200" and limited["failOnDataLoss"] == "false"
    assert streams.kafka_options("h:1", ["t"])["startingOffsets"] == "latest"
    assert streams.kafka_options("h:1", ["t"], starting_offsets='{"t":{"0":5}}')["startingOffsets"] == '{"t":{"0":5}}'


def test_table_scan_by_database(spark):
    spark.sql("create database if not exists testdb")
    spark.sql("create view testdb.items_v as select 1 as id")
    try:
        assert files.catalogue_table(spark, "items_v", "testdb").count() == 1
    finally:
        spark.sql("drop view testdb.items_v")
        spark.sql("drop database testdb")


class Writer:
    """Stands in for a DataFrame so that no database is needed."""

    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **kw):
        self.calls["options"] = kw
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self


def test_jdbc_append_settings(spark):
    fake = Writer()
    jdbc.appender(fake, "jdbc:x", "counts", user="u")
    assert fake.calls == {
        "format": "jdbc", "mode": "append",
        "options": {"url": "jdbc:x", "dbtable": "counts", "batchsize": "1000", "numPartitions": "8", "user": "u"},
    }
    rows = jdbc.cluster_rows(spark.createDataFrame([(1, "n", 2)], "id int, nm string, cluster int"), "id", "nm")
    assert rows.columns == ["schoolid", "name", "prediction", "accesse_date"] and dict(rows.dtypes)["accesse_date"] == "date"


def test_kafka_records(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    assert tuple(kafka.records(df, "t", F.col("text"), F.col("id")).head()) == ("t", "1", "x")
    assert kafka.records(df, "t", F.col("text")).head()["key"] is None


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError):
        streams.behaviour_stream(spark, "queue")
