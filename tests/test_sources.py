import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from homeledger import schema as S
from homeledger.plans import runs
from homeledger.sources import ads, listings, outputs
from homeledger.streaming import jobs


def write(path, text, encoding="utf-8"):
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def test_headered_csv(spark, tmp_path):
    path = write(tmp_path / "a.csv", (
        'Subject,PriceVND,AreaM2,District,CrawlDate,Link\n'
        '"Căn hộ ""A"", đẹp\ncó sân",2000000000,50,Quận 7,2026-01-02 03:04:05,http://x\n'
        'N/A,abc,NULL,none,,\n'), "utf-8-sig")
    rows = listings.scan_listing_csv(spark, path).orderBy("row_id").collect()
    a, b = rows
    assert a["name"] == 'Căn hộ "A", đẹp có sân' and a["price"] == 2e9 and a["area"] == 50.0 and a["district_name"] == "7"
    assert a["ward_name"] == "Unknown" and a["province_name"] == "Hồ Chí Minh" and a["published_at"].year == 2026
    assert a["property_type_name"] == S.APARTMENT and a["source_link"] == "http://x" and a["source"] == "chotot"
    assert b["name"] == "Unknown" and b["price"] is None and b["area"] is None and b["district_name"] == "none"
    assert b["published_at"] is None


def test_price_column_kind_is_inferred_from_the_whole_column(spark, tmp_path):
    text = write(tmp_path / "t.csv", "Subject,PriceVND,AreaM2\na,5,50\nb,2 tỷ,60\n")
    number = write(tmp_path / "n.csv", "Subject,PriceVND,AreaM2\na,5,50\nb,,60\n")
    def prices(path, kind):
        return [r["price"] for r in listings.scan_listing_csv(spark, path, price=kind).orderBy("name").collect()]
    assert prices(text, "infer") == [5e9, 2e9]
    assert prices(number, "infer") == [5.0, None]
    assert prices(text, "number") == [5.0, None]


def test_missing_files(spark, tmp_path):
    nowhere = str(tmp_path / "no.csv")
    for scan in (listings.scan_listing_csv, listings.scan_ragged_csv):
        empty = scan(spark, nowhere)
        assert empty.count() == 0 and empty.columns == S.COMMON_COLUMNS
        with pytest.raises(AnalysisException):
            scan(spark, nowhere, missing="error")


RAGGED = (
    "junk line\n"
    " Tên tin ,b,c,d,e,f,g,h,i,j,k,l,m\n"
    'A,"mô tả, ""x""\ndòng 2",Căn hộ chung cư,TPHCM,Quận 2 (TP. Thủ Đức),Phường 3,Lê Lợi,6 tỷ 600 triệu,70 m2,2,2,05/12/2025,http://a\n'
    "B,d,t,p,q,w,s,1 tỷ,50,1,1,06/12/2025\n"
    "C,d,t,p,q,w,s,1 tỷ,50,1,1,06/12/2025,u,extra\n"
    "A,other,Căn hộ chung cư,TPHCM,Q.2,Phường 3,x,6.6 tỷ,70,2,2,05/12/2025,http://b\n")


def test_ragged_csv(spark, tmp_path):
    path = write(tmp_path / "r.csv", RAGGED.encode("utf-8-sig") + b"D\xff,d,t,p,q,w,s,1 t\xe1\xbb\xb7,50,1,1,07/12/2025,u\n")
    profile = listings.ragged_profile(listings.read_ragged_csv(spark, path)).first()
    assert (profile["valid_rows"], profile["header_rows"], profile["skipped_rows"]) == (3, 1, 3)
    rows = listings.scan_ragged_csv(spark, path).orderBy("row_id").collect()
    assert [r["name"] for r in rows] == ["A", "A", "D�"]
    assert rows[0]["description"] == 'mô tả, "x" dòng 2' and rows[0]["price"] == 6.6e9 and rows[0]["published_at"].month == 12
    kept = listings.dedupe_source(listings.scan_ragged_csv(spark, path), "mogi").where("name = 'A'").collect()
    assert [r["source_link"] for r in kept] == ["http://a"]  # the first in the file


def test_ragged_csv_without_valid_rows(spark, tmp_path):
    path = write(tmp_path / "r.csv", "a,b\n")
    with pytest.raises(ValueError):
        listings.scan_ragged_csv(spark, path)


def test_bounded_scan_limits_before_and_after_the_filter(spark):
    df = spark.range(100).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, "HCM").otherwise("Hà Nội").alias("province_name"),
        F.lit(" Căn hộ  chung cư").alias("property_type_name")).repartition(3)
    def ids(**limits):
        return sorted(r["row_id"] for r in listings.bounded_filtered_scan(df, **limits).collect())
    assert ids(max_rows=3, scan_limit=50) == [0, 2, 4]
    assert ids(max_rows=99, scan_limit=5) == [0, 2, 4]
    with pytest.raises(ValueError):
        listings.bounded_filtered_scan(df, province="Huế", check=True)


def test_required_columns(spark):
    with pytest.raises(ValueError):
        outputs.prepare_predictions(spark.createDataFrame([(1.0,)], "price double"))
    with pytest.raises(ValueError):
        outputs.scan_metrics(spark.createDataFrame([("a",)], "Model string"))


def test_absent_split_side_is_none(spark, tmp_path):
    spark.range(1).select(F.lit("2026-01-01").alias("published_at")).write.parquet(str(tmp_path / "train"))
    train, test = outputs.scan_split_tables(spark, str(tmp_path / "train"), str(tmp_path / "test"))
    assert test is None and train.first()["split"] == "Train"


# ---- ads ----------------------------------------------------------------------------

def flat(spark, *documents):
    pages = spark.createDataFrame([(json.dumps(d),) for d in documents], "page string")
    parsed = pages.select(F.from_json("page", ads.PAGE_SCHEMA).alias("p")).select("p.*")
    return ads.flatten_ad(ads.explode_ad_pages(parsed), F.lit("now"), "UTC").orderBy("AdId").collect()


def test_pages_choose_their_list(spark):
    rows = flat(spark, {"ads": [{"ad_id": 1}], "data": [{"ad_id": 9}]}, {"ads": [], "data": [{"ad_id": 2}, "x", 5, None, [1]]},
                {"data": []}, {"ads": None}, {})
    assert [r["AdId"] for r in rows] == ["1", "2"]


def test_ad_details(spark):
    rows = flat(spark, {"ads": [
        {"ad_id": 1, "area": "Quận 3", "size": "", "list_time": "x", "ward_name": "", "ward": "P1"},
        {"ad_id": 2, "size": 0, "params": [{"id": "rooms", "value": None, "value_name": "", "label": None}, {"id": "rooms", "value": 3}]},
        {"ad_id": 3, "params": [{"id": "toilets", "value": 9}], "ad_params": [{"NAME": "x"}, {"name": "Toilets", "value": 0, "value_name": "2"}]},
        {"ad_id": 4, "list_id": 0, "url": "ftp://x", "list_time": 1767225600123, "parameters": {"id": "rooms"}},
        {"ad_id": 5, "webp_image": "http://w", "url": "http://u", "ad_link": 5},
        {"ad_id": 6, "list_id": False, "params": ["x", 3, None, [{"id": "floor"}], {"id": "rooms", "value": "3"}], "ward_name": False, "ward": "false"},
        {"ad_id": 7, "params": [{"id": "rooms", "value": False, "value_name": "two"}, {"id": "floor", "value": {}, "value_name": [], "label": "fl"},
                                {"id": "size", "value": "false"}, {"id": "toilets", "value": True}]},
    ]})
    by = {r["AdId"]: r for r in rows}
    # the top-level area answers both the size and the district
    assert by["1"]["AreaM2"] == "Quận 3" and by["1"]["District"] == "Quận 3" and by["1"]["Ward"] == "P1"
    assert by["1"]["NgayDang"] is None and by["1"]["ListTimeRaw"] == "x"
    assert by["2"]["AreaM2"] == "0" and by["2"]["BedRooms"] is None  # the first matching item decides
    assert by["3"]["BathRooms"] == "2"
    assert by["4"]["Link"] == "https://www.chotot.com/4.htm" and by["4"]["NgayDang"] == "2026-01-01 00:00:00"
    assert by["5"]["Link"] == "http://w"
    assert by["6"]["BedRooms"] == "3" and by["6"]["Ward"] == "false" and by["6"]["Link"] == "https://www.chotot.com/6.htm"
    assert by["7"]["BedRooms"] == "two" and by["7"]["Floor"] == "fl" and by["7"]["AreaM2"] == "false" and by["7"]["BathRooms"] == "true"
    assert rows[0].__fields__ == S.FLAT_AD_COLUMNS


# ---- streams and runs ---------------------------------------------------------------

def test_stream_keeps_the_first_of_repeats_at_any_age(spark, tmp_path):
    """Three batches, each a new start of the query from its checkpoint."""
    ad = lambda i, day, **more: {"ad_id": i, "list_id": i, "subject": "s", "list_time": 1767225600 + day * 86400, **more}
    no_id = lambda text: {"subject": "no id", "price_string": text}
    batches = [[[ad(i, 10, date="1") for i in range(20)] + [ad(3, 10, date="later in the page"), no_id("a"), no_id("b")]],
               [[ad(i, 5, date="2") for i in range(10, 40)], [ad(7, 20, date="2"), ad(39, 5, date="next page")]],
               [[ad(i, 1, date="3") for i in range(30, 60)] + [ad(0, 10, date="3"), no_id("c")]]]
    (tmp_path / "in").mkdir()
    for n, pages in enumerate(batches):
        write(tmp_path / "in" / f"p{n}.json", "\n".join(json.dumps({"ads": page}) for page in pages))
        jobs.land_ads(jobs.read_page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {(r["AdId"], r["PostDateText"], r["PriceString"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(str(i), "1" if i < 20 else "2" if i < 40 else "3", None) for i in range(60)} | {(None, None, "a")}
    assert got == want and spark.read.parquet(str(tmp_path / "out")).count() == len(want)
    assert not (tmp_path / "out" / "_temporary").exists()


def test_row_order_over_files_of_unequal_size(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    line = lambda i, name: f'{name},{"x" * 60},,,,,,{i},5,,,2026-01-01,u{i}'
    write(folder / "a.csv", "\n".join(line(i, "dup" if i == 3 else f"a{i}") for i in range(5)))
    write(folder / "b.csv", "\n".join(line(i, "dup" if i == 90 else f"b{i}") for i in range(100, 3000)) + "\n" + line(90, "dup"))
    kept = {}
    for size in ("128m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = listings.ragged_valid(listings.read_ragged_csv(spark, str(folder))).orderBy("row_id").collect()
        kept[size] = [r["url"] for r in rows]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert kept["128m"] == kept["20k"] == [f"u{i}" for i in [*range(5), *range(100, 3000), 90]]


def test_no_limit_keeps_every_row(spark):
    df = spark.range(50).select(F.col("id").alias("row_id"), F.lit(S.HCMC).alias("province_name"), F.lit(S.APARTMENT).alias("property_type_name"))
    assert listings.bounded_filtered_scan(df).count() == 50
    assert sorted(r["row_id"] for r in listings.bounded_filtered_scan(df, max_rows=5, scan_limit=20).collect()) == [0, 1, 2, 3, 4]
    assert listings.bounded_filtered_scan(df, province="Huế", max_rows=5).count() == 0


def test_write_and_read_back(spark, tmp_path):
    df = spark.range(20).select("id", F.lit(2026).alias("posted_year"), (F.col("id") % 3).cast("int").alias("posted_month"))
    paths = outputs.write_datasets({"clean": df}, str(tmp_path))
    assert sorted(spark.read.parquet(paths["clean"]).select("id", "posted_month").collect()) == sorted(
        df.select("id", "posted_month").collect())
    assert (tmp_path / "clean" / "posted_year=2026" / "posted_month=1").exists()


@pytest.mark.parametrize("broken", [False, True])
def test_datasets_in_csv_are_packed_and_bounded(spark, tmp_path, monkeypatch, broken):
    """Compressed files cannot be split: each holds few rows, and together all of them, in order."""
    monkeypatch.setattr(outputs, "PACKED_ROWS", 40)
    note = F.when(F.col("id") % 3 == 0, F.concat(F.lit('a "b",\n' if broken else 'a "b", '), F.col("id").cast("string"), F.lit(" c" * 50)))
    df = spark.range(0, 210, 1, 2).select(F.col("id").cast("string").alias("id"), note.alias("note"), F.lit(None).cast("double").alias("none"))
    packed = outputs.write_datasets({"copy": df}, str(tmp_path), "csv")["copy"]
    plain = outputs.write_datasets({"copy": df}, str(tmp_path / "plain"), "csv", packed=False)["copy"]
    files = {path: sorted(p for p in os.listdir(path) if p.startswith("part-")) for path in (packed, plain)}
    assert len(files[packed]) == 6 and all(p.endswith(".csv.gz") for p in files[packed])
    assert len(files[plain]) == 2 and all(p.endswith(".csv") for p in files[plain])
    size = {path: sum(os.path.getsize(f"{path}/{p}") for p in files[path]) for path in files}
    assert size[packed] < size[plain] / 3
    want = [tuple(r) for r in df.collect()]
    for path in files:
        got = listings.read_headered_csv(spark, path, numbered=True).orderBy("row_id").collect()
        assert [tuple(r)[1:] for r in got] == want
    for p in files[packed]:
        assert listings.read_headered_csv(spark, f"{packed}/{p}").count() <= 40


def test_packed_csv_of_no_rows_keeps_its_columns(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, b string")
    back = listings.read_headered_csv(spark, outputs.write_datasets({"copy": empty}, str(tmp_path), "csv")["copy"])
    assert back.columns == ["a", "b"] and back.count() == 0


def test_merge_run_rejects_unknown_modes(spark):
    empty = spark.createDataFrame([], S.COMMON_SCHEMA)
    with pytest.raises(ValueError):
        runs.merge_run(empty, empty, "all")


def test_run_summary_maps(spark):
    df = spark.createDataFrame([("mogi", "2026-01-01"), ("mogi", "2026-01-03"), ("chotot", "2026-01-02"), (None, "2026-01-02")],
                               "source string, t string").withColumn("published_at", F.col("t").cast("timestamp_ntz"))
    row = runs.run_summary(df, df.where("source = 'mogi'"), "label", "Random_Forest", {"mode": "merged"}).first()
    assert row["train_source_distribution"] == {"chotot": 1, "mogi": 2} and row["train_rows"] == 4
    assert row["test_source_distribution"] == {"mogi": 2} and row["mode"] == "merged" and row["test_end"].day == 3


# ---- records with line breaks -------------------------------------------------------

def broken(path, rows):
    import csv
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)


def test_records_with_line_breaks_from_split_files(spark, tmp_path):
    """Files in many blocks, quoted line breaks over their borders, lone quotes inside plain fields."""
    import csv
    import random
    rng = random.Random(7)
    kinds = ["a,b", 'x "y" z', 'l1\nl2,\n\n"q"\nl3', "", ',"', "\n".join(f"m{i}" for i in range(70)), "plain"]
    want = []
    for name in "ab":
        rows = [["id", "one", "two"]] + [[f"{name}{i}", rng.choice(kinds), rng.choice(kinds)] for i in range(300)]
        broken(tmp_path / f"{name}.csv", rows)
        with open(tmp_path / f"{name}.csv", "a") as f:
            f.write('z,5" pipe,plain "x" y\n\n')
        with open(tmp_path / f"{name}.csv", newline="") as f:
            want += [tuple(x or None for x in r) for r in csv.reader(f) if r][1:]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = listings.read_headered_csv(spark, str(tmp_path), numbered=True)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert [tuple(r)[1:] for r in df.orderBy("row_id").collect()] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_of_records_stay_where_they_are(spark, tmp_path):
    """Bytes that are no UTF-8 over the borders of blocks, a file that ends inside quotes, and no shuffle or sort above the lines."""
    record = lambda i: f'r{i},"' + "\n".join(f"{i}-{k}" for k in range(9)) + '"'
    body = "\n".join(["id,note", *map(record, range(200)), 'last,"open', "", " x"]).encode()
    (tmp_path / "a.csv").write_bytes(body.replace(b"-4", b"-\xff"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = listings.read_headered_csv(spark, str(tmp_path / "a.csv"), numbered=True)
        got = [(r["id"], r["note"]) for r in df.orderBy("row_id").collect()]
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(f"r{i}", "\n".join(f"{i}-{k}" for k in range(9)).replace("-4", "-\ufffd")) for i in range(200)]
    assert got == [*want, ("last", "open\n\n x")]

    def depth(line):
        return len(line) - len(line.lstrip(" :+-*()0123456789"))

    scans = [i for i, line in enumerate(plan) if "FileScan text" in line]
    assert len(scans) == 1
    above, at = [], depth(plan[scans[0]])
    for line in reversed(plan[:scans[0]]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    assert not [line for line in above if any(word in line for word in ("Exchange", "Sort", "Window", "Aggregate"))]


def test_ordered_files_are_not_one_task(spark, monkeypatch):
    """The files of the order query: several a side, in the order of their names."""
    from homeledger.catalog import source_queries
    seen = []
    monkeypatch.setattr(source_queries.outputs, "write_table", lambda df, path, fmt: seen.append(df) or path)
    monkeypatch.setattr(source_queries.I, "facts", lambda spark, sf: spark.range(50_000).select(
        F.col("id").alias("row_id"), F.col("id").cast("double").alias("price"), F.current_timestamp().alias("published_at")).repartition(3))
    monkeypatch.setattr(source_queries.listings, "read_headered_csv", lambda spark, path, numbered: spark.range(1).select(
        *[F.lit("1").alias(c) for c in ("price", "published_at", "number", "row_id")]))
    source_queries.scan_csv_order(spark, "")
    monkeypatch.undo()
    assert len(seen) == 2 and all("Coalesce" not in df._jdf.queryExecution().executedPlan().toString() for df in seen)


def test_plain_and_broken_files_parse_alike(spark, tmp_path):
    rows = [["Subject", "a b"], ["x", "1"], ["N/A", ""], ["short"], ["long", "2", "3"], [' pad ', '"q"']]
    broken(tmp_path / "plain.csv", rows)
    broken(tmp_path / "broken.csv", rows + [["x\ny", "z"]])
    read = lambda name: [tuple(r) for r in listings.read_headered_csv(spark, str(tmp_path / name), numbered=True).orderBy("row_id").drop("row_id").collect()]
    assert read("broken.csv") == [*read("plain.csv"), ("x\ny", "z")]


def test_ends_inside(spark):
    from homeledger.sources.records import ends_inside
    cases = {'a,b': False, '"a': True, '"a","b': True, '"a""b"': False, '"a"",': True, 'a"b': False, 'a,"b,c': True, '""': False, '"': True, 'x,""': False, '"""': True}
    df = spark.createDataFrame(list(cases.items()), "line string, want boolean")
    assert df.where(ends_inside(F.col("line")) != F.col("want")).collect() == []


def test_ads_cost_grows_with_their_items(spark):
    """Sixteen items cost little more than four times four: no item is parsed once for each other."""
    import time

    def seconds(n):
        page = json.dumps({"ads": [{"ad_id": 1, "params": [{"id": f"p{i}", "value": i} for i in range(n)]}]})
        pages = spark.range(3000).select(F.from_json(F.lit(page), ads.PAGE_SCHEMA).alias("p")).select("p.*")
        flat = ads.flatten_ad(ads.explode_ad_pages(pages), F.lit("now"), "UTC")
        best = []
        for _ in range(3):
            start = time.perf_counter()
            flat.write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(1)
    assert seconds(64) <= 5 * seconds(16) + 1


def test_late_rows_are_counted_and_other_days_are_left(spark, tmp_path):
    """Three batches, the last ones late by years and started anew; a day that no row touches keeps its files."""
    def land(name, rows):
        spark.createDataFrame(rows, "published_at string, source string").select(
            F.col("published_at").cast("timestamp_ntz").alias("published_at"), "source").write.parquet(str(tmp_path / "in" / name))
        arriving = spark.readStream.schema("published_at timestamp_ntz, source string").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        jobs.land_daily_coverage(arriving, *(str(tmp_path / x) for x in ("daily", "changes", "state"))).awaitTermination()

    def files(day):
        return {p.name for p in (tmp_path / "daily" / f"day={day}").glob("*.parquet")}

    (tmp_path / "in").mkdir()
    land("a", [("2026-01-02 23:59:59", "mogi"), ("2026-01-02 00:00:00", "mogi"), ("2026-01-03 05:00:00", None), (None, "mogi")])
    kept, redone = files("2026-01-03"), files("2026-01-02")
    land("b", [("2019-05-05 01:00:00", "chotot"), ("2026-01-02 12:00:00", "mogi"), ("2026-01-02 12:00:00", "chotot")])
    land("c", [("2019-05-05 02:00:00", "chotot")])
    assert files("2026-01-03") == kept and not files("2026-01-02") & redone
    got = spark.read.parquet(str(tmp_path / "daily")).select(F.col("day").cast("string"), "source", "rows").collect()
    assert sorted(map(tuple, got), key=str) == [
        ("2019-05-05", "chotot", 2), ("2026-01-02", "chotot", 1), ("2026-01-02", "mogi", 3), ("2026-01-03", None, 1)]


def test_counts_are_taken_while_writing(spark, tmp_path):
    from homeledger.operators import cleaning
    rows = [(2e9, 50.0, "2026-01-01"), (2e9, None, "2026-01-01"), (1.0, 50.0, "2026-01-01"), (2e9, 5.0, "2026-01-01"), (1e11, 10.0, "2026-01-01")]
    df = spark.createDataFrame(rows, "price double, area double, published_at string").withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))
    clean, funnel = cleaning.observed_funnel(df)
    paths, counts = outputs.write_counted({"clean": clean, "none": df.limit(0)}, str(tmp_path))
    assert counts == {"clean": 1, "none": 0} and spark.read.parquet(paths["clean"]).count() == 1
    assert cleaning.funnel_table(spark, funnel.get).collect() == cleaning.cleaning_funnel(df).collect()


def test_crawls_skip_failed_pages_and_stop_at_the_first_empty_one(spark, tmp_path):
    answers = {"a": [{"ads": [{"ad_id": 1}]}, None, {"data": [{"ad_id": 2}, "x"]}, {"ads": [], "data": None}, {"ads": [{"ad_id": 9}]}], "b": [{"ads": [{"ad_id": 5}]}]}
    for crawl, pages in answers.items():
        (tmp_path / crawl).mkdir()
        for n, page in enumerate(pages):
            write(tmp_path / crawl / f"page-{n:04}.json", json.dumps(page, indent=1) if page else '{"ads": [')
    pages = ads.read_page_folder(spark, str(tmp_path))
    got = ads.flatten_ad(ads.explode_ad_pages(ads.until_empty(pages)), F.lit("now"), "UTC")
    assert sorted((r["page"], r["AdId"]) for r in got.collect()) == [(0, "1"), (0, "5"), (2, "2")]
    ends = {r["crawl"][-1]: (r["stopped_at"], r["next_page"]) for r in ads.crawl_ends(pages).collect()}
    assert ends == {"a": (3, 3), "b": (None, 1)}
    # a crawl that goes on takes what has come since
    write(tmp_path / "a" / "page-0003.json", json.dumps({"ads": [{"ad_id": 3}]}))
    assert sorted(r["page"] for r in ads.until_empty(ads.read_page_folder(spark, str(tmp_path)), first=3).collect()) == [3, 4]


# ---- the ad stream reads a whole ad only when it is new -----------------------------

def test_keys_are_read_without_the_rest_of_an_ad(spark):
    texts = ['{"ad_id": 7, "list_id": "x", "subject": " s ", "ad_params": {"a": 1}, "price": false}', '{"subject": null, "ad_id": 1.50}',
             '{"ad_id": {"a": [1, 2]}, "list_id": [], "subject": false, "ad_id": "twice"}', "{}", '{"list_id": true, "params": [1, {"id": "size"}]}']
    pages = spark.createDataFrame([(texts, None), ([], texts + ["no object", None])], "ads array<string>, data array<string>")
    keys = S.DEDUPE_KEYS["crawl"]
    got = ads.with_ad_keys(ads.ad_texts(pages)).select(*keys).collect()
    want = ads.flatten_ad(ads.explode_ad_pages(pages), F.lit("now"), "UTC").select(*keys).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 10


def test_ads_are_parsed_behind_the_state(spark, tmp_path, monkeypatch):
    from homeledger.streaming import jobs
    seen, parse = [], ads.parse_ads
    monkeypatch.setattr(ads, "parse_ads", lambda df, *a: seen.append(df._jdf.queryExecution().analyzed().toString()) or parse(df, *a))
    page = '{"ads": [{"ad_id": 1, "list_id": 2, "subject": "a", "price": "%s"}]}'
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.txt").write_text(page % i)
        jobs.land_ads(jobs.read_page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert len(seen) == 2 and all("Aggregate" in p for p in seen)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["AdId"], r["PriceVND"]) for r in rows] == [("1", "0")] and rows[0]["CrawlDate"]
