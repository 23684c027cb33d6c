"""Adding, replacing and removing a file give the maps of a full fit, and only changed files are read."""

import pytest
from pyspark.sql import functions as F

from checks import frames
from conftest import SF
from tarmac.operators import cleaning, encoding
from tarmac.sources import file_maps, records


@pytest.fixture()
def text(spark):
    return frames.text_raw(spark, SF)


def _put(text, where, year, condition="true"):
    """One file of a year, in its own folder."""
    text.filter(f"YEAR = {year} AND {condition}").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{where}/{year}")
    return f"{where}/{year}"


def _full(spark, paths, years):
    df = cleaning.clean(records.read_records(spark, paths))
    return sorted(map(tuple, encoding.key_statistics(encoding.train_rows(df, years)).collect()), key=str)


def _held(spark, folder):
    return sorted(map(tuple, file_maps.encodings(spark, folder).statistics.collect()), key=str)


def test_add_replace_remove(spark, text, tmp_path):
    years, folder = (2021, 2022, 2023), f"{tmp_path}/maps"
    a, b = _put(text, tmp_path, 2021), _put(text, tmp_path, 2022)
    assert len(file_maps.refresh(spark, [a, b], folder, years=years)) == 2
    assert _held(spark, folder) == _full(spark, [a, b], years)
    assert file_maps.refresh(spark, [a, b], folder, years=years) == []
    c = _put(text, tmp_path, 2023)
    read = file_maps.refresh(spark, [a, b, c], folder, years=years)
    assert len(read) == 1 and "/2023/" in read[0] and _held(spark, folder) == _full(spark, [a, b, c], years)
    _put(text, tmp_path, 2022, "DAY_OF_MONTH <= 15")
    read = file_maps.refresh(spark, [a, b, c], folder, years=years)
    assert len(read) == 1 and "/2022/" in read[0] and _held(spark, folder) == _full(spark, [a, b, c], years)
    assert file_maps.refresh(spark, [b, c], folder, years=years) == []
    assert _held(spark, folder) == _full(spark, [b, c], years)
    assert file_maps.refresh(spark, [a, b, c], folder, years=years) == []  # what is back is still known


def test_files_without_training_rows_are_read_once(spark, text, tmp_path):
    a, z = _put(text, tmp_path, 2021), _put(text, tmp_path, 2025)
    folder = f"{tmp_path}/maps"
    assert len(file_maps.refresh(spark, [a, z], folder, years=(2021,))) == 2
    assert file_maps.refresh(spark, [a, z], folder, years=(2021,)) == []
    assert _held(spark, folder) == _full(spark, [a], (2021,))
    assert len(file_maps.refresh(spark, [a, z], folder, years=(2021, 2025))) == 2  # other years, other statistics
    assert _held(spark, folder) == _full(spark, [a, z], (2021, 2025))


def test_a_broken_refresh_is_not_counted(spark, text, tmp_path):
    """Statistics written by a refresh that broke off before its list of files."""
    a, folder = _put(text, tmp_path, 2021), f"{tmp_path}/maps"
    file_maps.refresh(spark, [a], folder, years=(2021,))
    stray = spark.read.parquet(f"{folder}/by_file/ARR_DEL15-1-2021").withColumn("batch", F.lit("broken"))
    spark.createDataFrame(stray.collect(), stray.schema).write.mode("append").parquet(f"{folder}/by_file/ARR_DEL15-1-2021")
    assert file_maps.refresh(spark, [a], folder, years=(2021,)) == []
    assert _held(spark, folder) == _full(spark, [a], (2021,))
