from __future__ import annotations

import pytest

from tendero.plans import jobs
from tendero.schemas import SCHEMAS, TABLE_NAMES
from tendero.sources import files, layout, sinks
from tests.conftest import day, line, one, records, ticket

CSV = (
    "﻿transaction_id,customer_id,transaction_date,store_id,total_amount,payment_method,loyalty_card,status\n"
    "T1,  ,2025-01-02,S1,10.50,CASH,True,COMPLETED\n"
    " T2 ,C1,2025-01-03 00:00:00,S1,,CARD, false ,RETURNED\n"
    "T3,C2,not a date,S2,abc,CASH,yes,COMPLETED\n"
)


def test_csv_cleaning(spark, tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(CSV, encoding="utf-8")
    good, _ = files.split_bad_rows(spark, str(path), "transactions")
    rows = records(good)
    assert rows[0] == ("T1", None, day("2025-01-02"), "S1", 10.5, "CASH", True, "COMPLETED")
    assert rows[1] == ("T2", "C1", day("2025-01-03"), "S1", None, "CARD", False, "RETURNED")
    with pytest.raises(Exception, match="is not of type"):
        files.read_csv_table(spark, str(path), "transactions").collect()


def test_bad_rows_are_kept_with_their_reason(spark, tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(CSV, encoding="utf-8")
    good, bad = files.split_bad_rows(spark, str(path), "transactions")
    assert good.count() == 2
    assert records(bad, "transaction_id", files.FAILED) == [("T3", ["transaction_date", "total_amount"])]


def test_short_lines_are_bad_rows(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    path.write_text("vendor_id,vendor_name,country,tier,is_shared_catalog\nV1,Uno,CR,A,True\nV2,Dos\n", encoding="utf-8")
    good, bad = files.split_bad_rows(spark, str(path), "vendors")
    assert records(good, "vendor_id", "is_shared_catalog") == [("V1", True)]
    assert records(bad, "vendor_id") == [("V2",)]


def test_load_all_tables_from_each_format(make, spark, tmp_path):
    tables = make([ticket("a", "2025-01-01")], [line("1", "a")])
    for name in TABLE_NAMES:
        sinks.export(tables[name], str(tmp_path / "csv" / f"{name}.csv"), "csv")
        for fmt in ("parquet", "orc", "json"):
            sinks.save(tables[name], path=str(tmp_path / fmt / name), fmt=fmt)
    for fmt in ("csv", "parquet", "orc", "json"):
        loaded = files.load_tables(spark, str(tmp_path / fmt), fmt)
        for name in TABLE_NAMES:
            assert [(f.name, f.dataType) for f in loaded[name].schema] == [(f.name, f.dataType) for f in SCHEMAS[name]]
            assert records(loaded[name]) == records(tables[name])


def test_save_replaces_every_partition(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    sinks.save(df, path=path, partition_by=("p",))
    assert records(sinks.save(df.filter("p = 'a'"), path=path, partition_by=("p",))) == [(1, "a")]
    with pytest.raises(ValueError):
        sinks.save(df)


def test_sql_views_and_catalog(make, spark):
    sinks.register_views(make([ticket("a", "2025-01-01"), ticket("b", "2025-01-01", status="RETURNED")], [line("1", "a")]))
    assert one(sinks.run_sql(spark, "SELECT SUM(ventas_netas) AS v FROM v_transacciones_ventas_netas; ")).v == 0
    assert sinks.run_sql(spark, "SELECT * FROM transactions", limit=1).count() == 1
    saved = sinks.run_sql(spark, "SELECT format, COUNT(*) AS n FROM stores GROUP BY format", save_as="stores_by_format")
    assert records(saved) == [("DESCUENTO", 1), ("EXPRESS", 2)]
    names = {r.nombre: r.tipo for r in sinks.list_tables(spark).collect()}
    assert names["v_items_ventas"] == "view" and names["stores_by_format"] == "table"
    assert records(sinks.describe_table(spark, "stores_by_format"), "nombre", "tipo") == [("format", "string"), ("n", "bigint")]
    with pytest.raises(ValueError):
        sinks.describe_table(spark, "no_such_table")
    spark.sql("DROP TABLE stores_by_format")


def test_bucketed_layout_joins_without_a_shuffle(make, spark):
    from tendero.operators.base import completed_lines

    tables = make([ticket(f"t{i}", "2025-01-01") for i in range(50)], [line(f"{i}", f"t{i % 50}") for i in range(200)])
    layout.store_retail(tables, "bucketed", 4)
    stored = layout.stored_retail(spark, "bucketed")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = completed_lines(stored)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert completed_lines(stored).count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in TABLE_NAMES:
            spark.sql(f"DROP TABLE bucketed_{name}")


def test_buckets_grow_with_the_facts(spark, make, monkeypatch):
    monkeypatch.setattr(layout, "LEAST_BUCKETS", 2)
    tables = make([ticket(f"t{i}", "2025-01-01") for i in range(50)], [line(f"{i}", f"t{i % 50}") for i in range(200)])
    assert [layout.buckets_for(tables, rows) for rows in (1000, 100, 24)] == [2, 3, 11]
    assert layout.buckets_for(make()) == 2
    monkeypatch.setattr(layout.buckets_for, "__defaults__", (50,))
    layout.store_retail(tables, "by_rows")
    try:
        described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED by_rows_transaction_items").collect()}
        assert described["Num Buckets"] == "5"
    finally:
        for name in TABLE_NAMES:
            spark.sql(f"DROP TABLE by_rows_{name}")


PERIODS = jobs.MartPeriods("2025-01-01", "2025-06-30", "2025-04-01", "2025-06-30", "2025-06-30")


def small(make):
    return make(
        [ticket("a", "2024-02-01", amount=5.0), ticket("b", "2025-02-01", amount=9.0, customer="C"), ticket("c", "2025-05-01", amount=2.0)],
        [line("1", "a"), line("2", "b"), line("3", "c", "I2")],
    )


def test_marts_are_written_and_counted(make, tmp_path):
    marts = jobs.run_marts(small(make), PERIODS, str(tmp_path / "marts"))
    counts = dict(records(jobs.mart_counts(marts)))
    assert counts["ventas_comparables"] == 1 and counts["quiebres_stock"] == 3 and len(counts) == 6
    again = jobs.run_marts(small(make), PERIODS, str(tmp_path / "marts"))
    assert dict(records(jobs.mart_counts(again))) == counts


def test_reports_and_dashboard_export(make, spark, tmp_path):
    paths = jobs.export_reports(small(make), PERIODS, str(tmp_path / "reports"))
    assert len(paths) == 10
    ticket_pivot = spark.read.option("header", True).csv(str(tmp_path / "reports" / "cohort_ticket"))
    assert ticket_pivot.columns == ["mes_cohorte", "0", "1", "2", "3", "6"]
    jobs.export_dashboard(small(make), PERIODS, str(tmp_path / "dash"))
    retention = spark.read.json(str(tmp_path / "dash" / "retention"))
    assert records(retention, "cohort", "m0") == [("2025-02", 100.0)]
    assert {"store_name", "item_name", "dias_sin_venta"} <= set(spark.read.json(str(tmp_path / "dash" / "stock")).columns)


def test_quotes_commas_and_blanks_survive(spark, tmp_path):
    path = tmp_path / "stores.csv"
    path.write_text(
        "\ufeffstore_id,store_name,country,city,format,size_sqm,opening_date,region\n"
        '\ufeffS1,"Tienda ""La, Paz""",CR,\t,EXPRESS\t,100,2023-01-01,Sur\u00a0\n', encoding="utf-8"
    )
    row = files.read_csv_table(spark, str(path), "stores").collect()[0]
    assert (row.store_id, row.store_name, row.country, row.city, row.format, row.region) == (
        "S1", 'Tienda "La, Paz"', "CR", None, "EXPRESS", "Sur",
    )


@pytest.mark.parametrize("line", ["1,,2024-01-01,S1,12x.5,CASH,True,COMPLETED", "1,,2024-01-01"])
def test_bad_lines_stop_a_plain_read(spark, tmp_path, line):
    path = tmp_path / "t.csv"
    path.write_text(
        "transaction_id,customer_id,transaction_date,store_id,total_amount,payment_method,loyalty_card,status\n"
        f"{line}\n2,,2024-01-01,S1,5.0,CASH,True,COMPLETED\n"
    )
    with pytest.raises(Exception, match="total_amount|MALFORMED"):
        files.read_csv_table(spark, str(path), "transactions").select("transaction_id", "total_amount").collect()
    good, bad = files.split_bad_rows(spark, str(path), "transactions")
    assert (good.count(), bad.count()) == (1, 1)


def test_exported_csv_reads_back_elsewhere(spark, tmp_path):
    import csv

    values = ['a "quoted", value', "plain", "tab\there", 'ends with "']
    sinks.export(spark.createDataFrame([(v,) for v in values], "x string").coalesce(1), str(tmp_path / "out"), "csv")
    (part,) = (tmp_path / "out").glob("part-*.csv")
    with part.open(newline="") as f:
        assert [r["x"] for r in csv.DictReader(f)] == values


# ---------------------------------------------------------------- CSV headers and records
def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


HEADER = "vendor_id,vendor_name,country,tier,is_shared_catalog"


def vendors_in(spark, folder, **options):
    return records(files.read_csv_table(spark, str(folder), "vendors", **options), *HEADER.split(","))


def test_columns_are_found_by_name_in_each_file(spark, tmp_path):
    folder = tmp_path / "v ö%20x"
    put(folder, "a.csv", f"{HEADER}\nV1,Uno,CR,A,True\n")
    put(folder, "b.csv", "\ufefftier , note,is_shared_catalog,country,vendor_name,vendor_id\r\nB,x,False,GT,Dos,V2\r\n")
    put(folder, "c.csv", f"{HEADER}\n")
    put(folder, "d.csv", "")
    assert vendors_in(spark, folder) == [("V1", "Uno", "CR", "A", True), ("V2", "Dos", "GT", "B", False)]
    assert vendors_in(spark, folder, line_breaks=False) == vendors_in(spark, folder)


def test_a_missing_or_doubled_column_is_refused(spark, tmp_path):
    put(tmp_path / "m", "a.csv", f"{HEADER}\nV1,Uno,CR,A,True\n")
    put(tmp_path / "m", "b.csv", "vendor_id,vendor_name,tier,is_shared_catalog\nV2,Dos,A,True\n")
    with pytest.raises(ValueError, match="b.csv lacks country"):
        files.read_csv_table(spark, str(tmp_path / "m"), "vendors")
    put(tmp_path / "t", "a.csv", f"{HEADER},tier\nV1,Uno,CR,A,True,B\n")
    with pytest.raises(ValueError, match="tier more than once"):
        files.read_csv_table(spark, str(tmp_path / "t"), "vendors")


def test_line_breaks_inside_quotes(spark, tmp_path):
    put(tmp_path / "q", "a.csv", f'{HEADER}\nV1,"Uno\n\n""S.A."", 1",CR,A,True\nV2,"5"" TV",GT,B,False\nV3,Tres,SV,C,True\n')
    put(tmp_path / "q", "b.csv", f"{HEADER}\nV4,Cuatro,SV,C,True\n")
    got = vendors_in(spark, tmp_path / "q")
    assert [r[1] for r in got] == ['Uno\n\n"S.A.", 1', '5" TV', "Tres", "Cuatro"]
    spans = {r.file[-5:]: r.spans for r in files.survey_csv(spark, str(tmp_path / "q")).collect()}
    assert spans == {"a.csv": True, "b.csv": False}  # only the first one is parsed by a single task


def test_bad_rows_of_reordered_files(spark, tmp_path):
    put(tmp_path / "b", "a.csv", "cost,item_id,item_name,brand,vendor_id,category,department\n1.5,I1,Pan,M,V1,A,D\nx,I2,Pan,M,V1,A,D\n")
    good, bad = files.split_bad_rows(spark, str(tmp_path / "b"), "products")
    assert records(good, "item_id", "cost") == [("I1", 1.5)]
    assert records(bad, "item_id", "cost") == [("I2", "x")] and bad.first()[files.FAILED] == ["cost"]
