import os
from datetime import date

import pytest
from vendor_files import member_text, put_daily, put_history, write_zip, ymd

from panelwright.sources import archive, objects
from panelwright.sources.sql import read_range, year_predicates
from panelwright.specs import EXPOSURE_DATA, IDS_DATA, RETURNS_DATA, schema_of

D = [date(2023, 12, 29), date(2024, 1, 2), date(2024, 1, 3)]


def row(b, d, price=1.5):
    return [b, price, None, "S", "USD", 0.1, ymd(d)]


def test_daily_scan(spark, tmp_path):
    root = str(tmp_path)
    put_daily(root, RETURNS_DATA, D[0], [row("A", D[0]), row("B", D[0], None)])
    put_daily(root, RETURNS_DATA, D[2], [row("A", D[2])])
    got = archive.scan_sessions(spark, root, RETURNS_DATA, D)  # D[1] has no archive
    assert got.schema == RETURNS_DATA.raw
    assert sorted((r["!Barrid"], r["Price"], r["Capt"], r["DataDate"]) for r in got.collect()) == [
        ("A", 1.5, None, "20231229"), ("A", 1.5, None, "20240103"), ("B", None, None, "20231229"),
    ]
    assert got.rdd.getNumPartitions() == 2
    latest = archive.scan_latest(spark, root, RETURNS_DATA, D)
    assert [r["DataDate"] for r in latest.collect()] == ["20240103"]
    with pytest.raises(FileNotFoundError):
        archive.scan_sessions(spark, root, RETURNS_DATA, [D[1]])
    empty = archive.scan_latest(spark, root, IDS_DATA, D)
    assert empty.schema == IDS_DATA.raw and empty.count() == 0


def test_history_scan_one_archive_a_year(spark, tmp_path):
    root = str(tmp_path)
    put_history(root, RETURNS_DATA, 2023, {D[0]: [row("A", D[0])]})
    put_history(root, RETURNS_DATA, 2024, {D[1]: [row("A", D[1])], D[2]: [row("A", D[2])]})
    put_history(root, RETURNS_DATA, 2024, {D[2]: [row("X", D[2])]}, suffix="_b")  # not this dataset's name
    assert archive.scan_history(spark, root, RETURNS_DATA, [2024]).count() == 2
    assert archive.scan_history(spark, root, RETURNS_DATA, [2023, 2024]).count() == 3
    with pytest.raises(ValueError):
        archive.scan_history(spark, root, IDS_DATA, [2024])


def test_history_scan_many_archives_a_year(spark, tmp_path):
    root = str(tmp_path)
    put_history(root, EXPOSURE_DATA, 2024, {D[1]: [["A", "f", 1.0, ymd(D[1])]]}, suffix="01")
    put_history(root, EXPOSURE_DATA, 2024, {D[2]: [["A", "f", 2.0, ymd(D[2])]]}, suffix="02")
    put_history(root, EXPOSURE_DATA, 2023, {D[0]: [["A", "f", 3.0, ymd(D[0])]]})
    assert sorted(r["Exposure"] for r in archive.scan_history(spark, root, EXPOSURE_DATA, [2024]).collect()) == [1.0, 2.0]


def test_missing_year_is_an_error(spark, tmp_path):
    put_history(str(tmp_path), RETURNS_DATA, 2023, {D[0]: [row("A", D[0])]})
    with pytest.raises(FileNotFoundError, match="2024"):
        archive.scan_history(spark, str(tmp_path), RETURNS_DATA, [2023, 2024])


def test_other_column_order_missing_column_full_trailer_and_origin(spark, tmp_path):
    schema = schema_of("_member string, !Barrid string, Price double, Gone string")
    text = member_text(["Price", "Extra", "!Barrid"], [[2.0, "e", "A"]], 1, trailer="||[End of File]")
    write_zip(f"{tmp_path}/z.zip", {"m.1": text})
    archive.register(spark)
    reader = spark.read.format("archive").schema(schema).option("root", str(tmp_path)).option("skipLines", 1)
    reader = reader.option("optional", '["Gone"]')
    got = reader.option("members", '[["z.zip", "m.1"]]').load().collect()
    assert [tuple(r) for r in got] == [("m.1", "A", 2.0, None), ("m.1", "[End of File]", None, None)]
    with pytest.raises(Exception):
        reader.option("members", '[["z.zip", "m.2"]]').load().collect()


def test_damaged_rows_and_values_fail(spark, tmp_path):
    for i, bad in enumerate(["A|1.0", "A|x|USD"]):
        path = f"{tmp_path}/bad{i}.txt"
        with open(path, "w") as f:
            f.write(f"!Barrid|Price|Currency\n{bad}\n[End of File]\n")
        frame = archive.scan_text(spark, [path], schema_of("!Barrid string, Price double, Currency string"))
        with pytest.raises(Exception):
            frame.collect()


def test_plain_text_scan(spark, tmp_path):
    path = f"{tmp_path}/plain.txt"
    with open(path, "w") as f:
        f.write(member_text(["!Barrid", "Price"], [["A", 1.0]], 2))
    assert archive.scan_text(spark, [path], schema_of("!Barrid string, Price double"), 2).count() == 1


def test_sql_range_pushes_down(spark, tmp_path):
    path = f"{tmp_path}/dsf"
    spark.sql(
        "select date_add(date'2023-12-30', cast(id as int)) date, id permno, cast(id as string) vol, 'NAMES' event, 1 unused from range(6)"
    ).write.parquet(path)
    out = read_range(spark, path, schema_of("date date, permno bigint, vol bigint"), D[1], D[2])
    assert sorted(tuple(r) for r in out.collect()) == [(D[1], 3, 3), (D[2], 4, 4)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date" in plan and "unused" not in plan


def test_year_predicates():
    assert year_predicates(date(2023, 6, 1), date(2024, 2, 1)) == [
        "date BETWEEN DATE '2023-06-01' AND DATE '2023-12-31'",
        "date BETWEEN DATE '2024-01-01' AND DATE '2024-02-01'",
    ]


def test_objects(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, s string")
    objects.write_csv(df, f"{tmp_path}/c")
    assert sorted(map(tuple, objects.read_csv(spark, f"{tmp_path}/c").collect())) == [(1, "a"), (2, None)]
    typed = objects.read_csv(spark, f"{tmp_path}/c", schema_of("x string, s string"))
    assert typed.schema["x"].dataType.simpleString() == "string"
    objects.write_parquet(df, f"{tmp_path}/p", "x")
    objects.write_parquet(df.where("x = 2").withColumn("s", df.s.cast("string")), f"{tmp_path}/p", "x")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    objects.write_parquet(df.limit(1), f"{tmp_path}/q")
    listed = objects.list_files(spark, str(tmp_path), "*.parquet")
    assert listed.count() >= 3 and set(listed.columns) == {"path", "length", "modified"}
    assert os.path.exists(tmp_path)


def test_member_without_rows_and_long_member(spark, tmp_path):
    schema = schema_of("!Barrid string, Price double, Currency string")
    many = [[f"A{i}", i / 2, "USD" * 20] for i in range(120_000)]  # several read blocks
    for name, rows in (("empty", []), ("long", many)):
        with open(f"{tmp_path}/{name}.txt", "w") as f:
            f.write(member_text(schema.fieldNames(), rows, 2))
    assert archive.scan_text(spark, [f"{tmp_path}/empty.txt"], schema, 2).count() == 0
    both = archive.scan_text(spark, [f"{tmp_path}/*.txt"], schema, 2)
    assert both.selectExpr("count(*)", "sum(Price)").first()[:] == (120_000, sum(r[1] for r in many))


def test_members_are_packed_by_bytes_in_order(spark, tmp_path):
    sized = [("a", f"m{i}", 40_000 if i == 7 else 400) for i in range(50)]
    for slots in (1, 3, 8, 1000):
        packs = archive.pack(sized, slots)
        assert [m for p in packs for m in p] == [(a, m) for a, m, _ in sized]
        assert min(slots, 8) <= len(packs) <= 2 * slots + 1
    large = [("a", f"m{i}", archive.PACK_BYTES // 2) for i in range(10)] + [("a", "huge", 5 * archive.PACK_BYTES), ("a", "z", 1)]
    assert [len(p) for p in archive.pack(large, 1)] == [1] * 12
    assert archive.pack([], 4) == []


def test_many_members_in_few_tasks(spark, tmp_path):
    sessions = [date(2023, 1 + i // 28, 1 + i % 28) for i in range(300)]
    rows = {d: [row("A", d, float(i)), row("B", d, -float(i))] for i, d in enumerate(sessions)}
    put_history(str(tmp_path), RETURNS_DATA, 2023, rows)
    got = archive.scan_history(spark, str(tmp_path), RETURNS_DATA, [2023], origin=True)
    assert got.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism + 1
    kept = [(r["DataDate"], r["!Barrid"], r["Price"], r["_line"]) for r in got.collect() if r["!Barrid"] in "AB"]
    assert kept == [(ymd(d), b, s * i, k) for i, d in enumerate(sessions) for k, (b, s) in enumerate([("A", 1.0), ("B", -1.0)])]
    assert {r["_archive"] for r in got.select("_archive").distinct().collect()} == {"SMD_USSLOW_100_D_2023.zip"}


def test_listing_names_absent_members_and_skips_absent_archives(spark, tmp_path):
    root = f"{tmp_path}/odd [name]"
    put_daily(root, RETURNS_DATA, D[0], [row("A", D[0])])
    here = RETURNS_DATA.daily_archive(D[0])
    found = archive.listing(spark, root, [(here, "", "gone"), ("nothing*.zip", "", None), (here, "USSLOW", None), (here, "x", None)])
    assert [[m[1] for m in f] for f in found] == [["gone"], [], [RETURNS_DATA.daily_member(D[0])], []]
    assert found[0][0][2] == 0 < found[2][0][2]
    with pytest.raises(Exception, match="gone"):
        archive._scan(spark, root, RETURNS_DATA, found[0]).collect()


def test_stream_offsets_are_digests_with_a_log(spark, tmp_path):
    root, log = str(tmp_path / "root"), tmp_path / "log"
    options = {"root": root, "archives": f'["{RETURNS_DATA.daily_folder}/*.zip"]', "memberPrefix": RETURNS_DATA.member + ".", "log": str(log)}
    reader = archive.ArchiveStreamReader(RETURNS_DATA.raw, options)
    assert reader.latestOffset() == {} == reader.initialOffset()
    offsets = [{}]
    for d in D:
        put_daily(root, RETURNS_DATA, d, [row("A", d)])
        offsets.append(reader.latestOffset())
        assert len(str(offsets[-1])) < 100 and reader.latestOffset() == offsets[-1]

    def fresh(start, end):
        return [os.path.basename(path) for p in reader.partitions(start, end) for path, _ in p.members]

    names = [os.path.basename(RETURNS_DATA.daily_archive(d)) for d in D]
    assert fresh({}, offsets[3]) == names and fresh(offsets[1], offsets[3]) == names[1:] and fresh(offsets[3], offsets[3]) == []
    for k, path in enumerate(sorted(log.glob("*.json"), key=lambda p: p.stat().st_size)):
        os.utime(path, (k, k))
    reader.commit(offsets[2])
    assert {p.stem for p in log.glob("*.json")} == {offsets[2]["state"], offsets[3]["state"]}
    # a new reader, as after a restart, goes on from what was committed
    reader = archive.ArchiveStreamReader(RETURNS_DATA.raw, options)
    assert fresh(offsets[2], reader.latestOffset()) == names[2:]


def test_members_are_read_chunk_by_chunk(tmp_path, monkeypatch):
    """While a batch is in use no more of the member has been read than its chunk; a row longer than a chunk comes whole."""
    import io

    class Counted(io.BytesIO):
        def readinto(self, into):
            got = super().readinto(into)
            self.taken = getattr(self, "taken", 0) + got
            return got

        def read(self, size=-1):
            got = super().read(size)
            self.taken = getattr(self, "taken", 0) + len(got)
            return got

    monkeypatch.setattr(archive, "CHUNK_BYTES", 1 << 16)
    body = b"".join(b"%d|%s\r\n" % (i, b"x" * 90) for i in range(20000)) + b"7|" + b"y" * 200_000 + b"\n\n[End of File]\n"
    stream = Counted(b"n|text\n" + body)
    rows = taken = 0
    texts = []
    for batch in archive.ArchiveReader(schema_of("n bigint, text string"), {})._batches(stream, "path", "member"):
        rows, taken = rows + batch.num_rows, taken + batch.nbytes
        texts.append(batch.column(1)[batch.num_rows - 1].as_py())
        assert stream.taken < taken + 400_000
    assert rows == 20001 and texts[-1] == "y" * 200_000


def test_blank_and_marker_lines_at_chunk_ends(monkeypatch):
    import io

    reader = archive.ArchiveReader(schema_of("a string, b double"), {})
    for size in (1, 3, 5, 1 << 20):
        monkeypatch.setattr(archive, "CHUNK_BYTES", size)
        got = lambda body: [r for b in reader._batches(io.BytesIO(b"a|b\n" + body), "p", "m") for r in b.to_pylist()]
        assert got(b"") == got(b"\n\n") == got(b"[End of File]") == got(b"\r\n[End of File]\r\n") == []
        assert got(b'"x|y"|1\r\n\nz|2\n[End of File]\n') == [{"a": "x|y", "b": 1.0}, {"a": "z", "b": 2.0}]
