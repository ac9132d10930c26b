"""The id filter with state: restarts, the primed backlog, and forgetting."""

import json
import time

from pyspark.sql import functions as F

from lakesearch.streaming import ids, jobs


def feed(folder, name, numbers):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"id": i, "title": f"t{i}"}) + "\n" for i in numbers))


def drain(spark, tmp_path, primed, ttl=None):
    """Ids sent by one run over what has come since the last, and the rows of state after it."""
    lines = jobs.read_text_folder(spark, str(tmp_path / "in"), max_files=1)
    items = lines.select(F.from_json("value", "id long, title string").alias("e")).select("e.*")
    sent = []
    fresh = ids.first_seen(items, spark.createDataFrame([(i,) for i in primed], "id long"), ttl)
    run = fresh.writeStream.foreachBatch(lambda rows, _: sent.extend((r.id, r.title) for r in rows.collect()))
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # see `ids`
    try:
        query = run.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        ended = query.awaitTermination(120)
        query.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert ended
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return sorted(sent, key=str), states[-1] if states else None


def test_ids_are_sent_once_over_restarts(spark, tmp_path):
    feed(tmp_path / "in", "a.txt", [1, 2, 2, 3, 8, None, None])
    feed(tmp_path / "in", "b.txt", [3, 4, 9])
    first, _ = drain(spark, tmp_path, primed=[8, 9, 9])
    assert first == sorted([(i, f"t{i}") for i in (1, 2, 3, 4, None)], key=str)
    feed(tmp_path / "in", "c.txt", [1, 4, 5, 8, None])
    # The primed list is part of the state: what is named later changes nothing.
    second, known = drain(spark, tmp_path, primed=[5])
    assert second == [(5, "t5")]
    assert known == 8  # 1 to 5, 8, 9 and the rows without id


def test_forgotten_ids_leave_the_state(spark, tmp_path):
    feed(tmp_path / "in", "a.txt", range(40))
    first, known = drain(spark, tmp_path, primed=[100], ttl=5)
    assert len(first) == 40 and known <= 41 * 3  # with the entries that order them by time
    time.sleep(6)
    feed(tmp_path / "in", "b.txt", [7, 100, 100])
    feed(tmp_path / "in", "c.txt", [7])
    second, after = drain(spark, tmp_path, primed=[], ttl=5)
    assert {i for i, _ in second} == {7, 100}
    assert after < known / 4
