"""Archives written by ranges of their sorted lines."""

import zipfile

from pyspark.sql import functions as F

from panelwright import specs as sp
from panelwright.plans import job_catalog
from panelwright.session import Staging


def test_large_archive_is_sorted_by_several_tasks(spark, monkeypatch):
    """One archive of most lines between two small ones; its member is put together from the pieces of several tasks."""
    data = sp.FACTOR_RETURN_DATA
    days = F.when(F.col("id") < 5, "19960102").when(F.col("id") < 3000, "19960103").otherwise("19960104")
    rows = spark.range(3005).select(F.format_string("F%04d", "id").alias("!Factor"), F.lit(0.5).alias("DlyReturn"), days.alias("DataDate"))
    staged, put = [], Staging.put
    monkeypatch.setattr(Staging, "put", lambda self, df: staged.append(put(self, df).collect()) or put(self, df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        job_catalog.put_daily(rows.select(data.raw.fieldNames()), data, root := job_catalog.local_root(spark))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(map(len, staged)) >= 4
    heads = ["preamble"] * data.skip_lines + ["|".join(data.raw.fieldNames())]
    for day, ids in (("19960102", range(5)), ("19960103", range(5, 3000)), ("19960104", range(3000, 3005))):
        with zipfile.ZipFile(f"{root}/{data.daily_folder}/{data.daily_zip}_{day[2:]}.zip") as archive:
            assert archive.namelist() == [f"{data.member}.{day}"]
            lines = archive.read(f"{data.member}.{day}").decode().split("\n")
        body = {"!Factor": "F{:04d}", "DlyReturn": "0.5", "DataDate": day}
        want = ["|".join(body[c] for c in data.raw.fieldNames()).format(i) for i in ids]
        assert lines == [*heads, *want, sp.END_OF_FILE, ""]
