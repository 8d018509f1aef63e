from __future__ import annotations

from datetime import datetime

from tidemark.specs import ACTIVITY
from tidemark.streaming.landed import clean_stream, write_stream


def test_landed_files_stream(spark, tmp_path):
    header = ",".join(f'"{c}"' for c in ACTIVITY.raw_columns)
    line = '"2024-01","Toronto, Ontario","2021S0503535","Housing starts","Row units","Units","300","units","0","v1","1.1","{}","","","","0"'

    def land(sha, value):
        folder = tmp_path / "in" / "release=20240201T133000Z" / f"sha256={sha}"
        folder.mkdir(parents=True)
        (folder / "data.csv").write_text(f"{header}\n{line.format(value)}\n")

    def run():
        write_stream(clean_stream(spark, str(tmp_path / "in"), ACTIVITY), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).orderBy("source_archive_sha256").collect()

    land("aa", 7)
    rows = run()
    assert [(r.housing_count, r.source_archive_sha256, r.source_release_timestamp) for r in rows] == [(7, "aa", datetime(2024, 2, 1, 13, 30))]
    land("bb", 9)
    assert [r.housing_count for r in run()] == [7, 9]
