"""Files that cannot be read are set aside with a reason, and cost no other file its rows."""

from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from velotrace.plans import daily
from velotrace.sources import quarantine, tables


def states(found):
    return {r.path.rsplit("/", 1)[1]: (r.state, r.rows) for r in found.files.collect()}


def test_csv_files(spark, tmp_path):
    good = 'device_id,note,position_speed\n1,"a ""b"", c\nd",2.5\n2,,x\n'
    files = {
        "good.csv": good.encode(),
        "other.csv": b"note,device_id,extra\nz,7,\\N\n",
        "cut.csv": b"device_id,note\n1,a\n2",
        "long.csv": b"device_id,note\n1,a,b\n",
        "quotes.csv": b'device_id,note\n1,"a\n2,b\n',
        "latin.csv": "device_id,note\n1,é\n".encode("latin-1"),
        "head.csv": b"device_id,note\n",
        "nothing.csv": b"",
        "blank.csv": b"\n \n",
        "other.txt": b"not asked for",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    found = quarantine.read_good(spark, str(tmp_path), "csv")
    unreadable, empty = ("unreadable", 0), ("empty", 0)
    assert states(found) == {
        "good.csv": ("ok", 2), "other.csv": ("ok", 1), "cut.csv": unreadable, "long.csv": unreadable,
        "quotes.csv": unreadable, "latin.csv": unreadable, "head.csv": empty, "nothing.csv": empty, "blank.csv": empty,
    }
    rows = {r.device_id: r for r in found.rows.collect()}
    assert set(rows) == {1, 2, 7}
    assert rows[1].position_speed == 2.5 and rows[2].position_speed is None and rows[7].position_speed is None
    assert rows[1].source_file.endswith("good.csv") and rows[7].extra == "\\N"
    assert all(r.reason for r in found.rejects.collect())


def test_parquet_files(spark, tmp_path):
    def file(name, table, damage=lambda b: b):
        pq.write_table(table, tmp_path / name)
        (tmp_path / name).write_bytes(damage((tmp_path / name).read_bytes()))

    numbers = pa.table({"device_id": list(range(2000)), "text": [f"{i}" * 5 for i in range(2000)]})
    file("good.parquet", numbers)
    file("more.parquet", pa.table({"device_id": [-1], "ain.12": [0.5]}))
    file("cut.parquet", numbers, lambda b: b[: len(b) // 2])
    # The footer is whole, a page is not.
    file("page.parquet", numbers, lambda b: b[:200] + b"\x00" * 800 + b[1000:])
    file("none.parquet", numbers.slice(0, 0))
    (tmp_path / "zero.parquet").write_bytes(b"")
    found = quarantine.read_good(spark, str(tmp_path), "parquet")
    assert states(found) == {
        "good.parquet": ("ok", 2000), "more.parquet": ("ok", 1), "cut.parquet": ("unreadable", 0),
        "page.parquet": ("unreadable", 0), "none.parquet": ("empty", 0), "zero.parquet": ("empty", 0),
    }
    assert found.rows.count() == 2001 and found.rows.filter("`ain.12` = 0.5").count() == 1


def test_nothing_good(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"")
    found = quarantine.read_good(spark, str(tmp_path), "csv")
    assert found.rows is None and found.rejects.count() == 1
    gone = quarantine.read_good(spark, str(tmp_path / "missing"), "csv")
    assert gone.rows is None and gone.files.count() == 0


def test_a_day_is_published_without_its_bad_files(spark, frame, tmp_path):
    rows = frame("device_id long, timestamp double, snapped_lat double, snapped_lon double", (1, 5.0, 51.0, 0.0))
    for region in ("wales", "sydney"):
        rows.coalesce(1).write.parquet(f"{tmp_path}/in/region={region}/date=2024-01-15")
    bad = next((tmp_path / "in/region=sydney/date=2024-01-15").glob("part-*"))
    bad.write_bytes(bad.read_bytes()[:50])
    day = date(2024, 1, 15)
    found = daily.publish_good(spark, f"{tmp_path}/in", day, f"{tmp_path}/rejects")
    assert [(r.device_id, r.position_latitude) for r in found.collect()] == [(1, 51.0)]
    # The file no longer has the checksum that its writer left beside it.
    assert [r.state for r in spark.read.parquet(f"{tmp_path}/rejects").collect()] == ["unreadable"]
    assert daily.publish_good(spark, f"{tmp_path}/in", date(2024, 1, 16)) is None


def test_days_and_listings_of_odd_folders(spark, tmp_path):
    for folder in ("year=2024/month=01/day=15", "year=__HIVE_DEFAULT_PARTITION__/month=x/day=y"):
        (tmp_path / folder).mkdir(parents=True)
    assert tables.days_in(spark, str(tmp_path)) == [date(2024, 1, 15)]
    assert tables.list_files(spark, str(tmp_path / "missing")).count() == 0
    with pytest.raises(Exception):
        tables.list_files(spark, "unknown://root").count()
