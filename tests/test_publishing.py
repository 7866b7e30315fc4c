"""Batches are sent once each, also by a run that was killed in between."""

import json

import pytest

from errscope.plans.daily import publish_batches, read_batches


def rows(spark):
    return spark.createDataFrame([(i, f"2024-01-01T00:00:{i:02d}", f'said "{i}"\\n') for i in range(47)], "msg_id long, timestamp string, error_message string").repartition(3)


def sent(spark, path):
    return sorted((r.batch, json.loads(r.message)["data"]["msg_id"]) for r in read_batches(spark, path).collect())


WANT = [(i // 5, i) for i in range(47)]


def test_every_batch_once(spark, tmp_path):
    path, portions = str(tmp_path / "out"), []
    assert read_batches(spark, path).count() == 0
    publish_batches(rows(spark), path, ["msg_id"], 5, commits=4, on_commit=lambda a, b: portions.append((a, b)))
    assert portions == [(0, 2), (3, 5), (6, 8), (9, 9)] and sent(spark, path) == WANT
    publish_batches(rows(spark), path, ["msg_id"], 5, commits=4)  # nothing is left to send
    assert sent(spark, path) == WANT


def test_killed_run_goes_on(spark, tmp_path):
    path = str(tmp_path / "out")

    def stop(first, last):
        if first == 3:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        publish_batches(rows(spark), path, ["msg_id"], 5, commits=4, on_commit=stop)
    assert sent(spark, path) == WANT[:30]
    # files of a portion that never reached the manifest are not seen
    rows(spark).selectExpr("99L as batch", "'lost' as message").write.json(f"{path}/portion=dead")
    publish_batches(rows(spark), path, ["msg_id"], 5, commits=4)
    assert sent(spark, path) == WANT


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    publish_batches(rows(spark).limit(0), path, ["msg_id"], 5)
    assert read_batches(spark, path).count() == 0
