"""The stream of documents, stored as one file or as a folder of files."""

import shutil

import pytest

from checks import queries

ROWS = [(i, f"ab ab cab {'abc ' * (i % 4)}", "en") for i in range(12)]


@pytest.mark.parametrize("parts", [1, 3])
def test_documents_may_be_a_file_or_a_folder(spark, tmp_path, parts):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    rows.repartition(parts).write.parquet(str(tmp_path / "made"))
    made = sorted((tmp_path / "made").glob("part-*.parquet"))
    assert len(made) == parts
    if parts == 1:
        shutil.copy(made[0], tmp_path / "documents.parquet")
    else:
        shutil.copytree(tmp_path / "made", tmp_path / "documents.parquet")
    got = queries.encode_stream(spark, str(tmp_path)).collect()
    expected = queries.encode_char(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected)) and len(got) == len(ROWS)
