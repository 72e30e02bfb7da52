"""What the layers of a stream leave on disk while it runs."""

from glob import glob

import pyarrow.parquet as pq
import pytest

from tallyhouse.plans import pipeline, queries
from tallyhouse.sources import Lake


def codecs(lake, table):
    files = glob(f"{lake.location(table).removeprefix('file:')}/**/*.parquet", recursive=True)
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}


@pytest.mark.parametrize("partitions", [(), ("month",)])
def test_tables_of_the_layers_are_compressed_well(spark, tmp_path, partitions):
    lake = Lake(spark, str(tmp_path / "lake"), prefix="z_")
    lake.create_layers()
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, month int")
    try:
        for _ in range(2):
            lake.replace(rows, "t", None, partitions)
            assert codecs(lake, "t") == {"ZSTD"}
        lake.append(rows, "t", None, partitions)
        assert codecs(lake, "t") == {"ZSTD"} and lake.read("t").count() == 4
        if partitions:
            lake.replace_partitions(rows, "t", None, partitions)
            assert codecs(lake, "t") == {"ZSTD"} and lake.read("t").count() == 2
    finally:
        lake.forget()


class NoLines:
    """A workspace whose staged bronze must not be asked for."""

    def __init__(self, spark, area, lines):
        self.spark, self.area, self.bronze_once = spark, area, lines

    @property
    def bronze(self):
        raise AssertionError("a staged bronze would lie beside all layers")

    def stage(self, df):
        return self.area.stage(df)


def test_stream_keeps_no_bronze_of_its_own_and_drops_shuffles_between_steps(spark, area, monkeypatch):
    kept = []
    monkeypatch.setattr(pipeline, "release", lambda session: kept.append("released"), raising=False)
    for name in ("build_silver", "build_gold"):
        own = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, own=own, name=name, **k: (kept.append(name), own(*a, **k)))
    text = "bronze_id string, invoice string, stock_code string, description string, quantity string, invoice_date string, unit_price string, customer_id string, country string"
    lines = spark.createDataFrame(
        [(f"{n}-1-7-3", str(n), "7", "thing", "2", "1998-01-05 08:26:00", "1.50", "11", "france") for n in range(1, 9)], text
    )
    found = queries.stream_layers(NoLines(spark, area, lines)).collect()
    assert [(r.sale_month, r.n_lines, r.quantity, r.loads) for r in found] == [(199801, 8, 16, 2)]
    assert [k for k, after in zip(kept, kept[1:]) if after.startswith("build")] == ["released"] * 4 and kept[-1] == "released"
