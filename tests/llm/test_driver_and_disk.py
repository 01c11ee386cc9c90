"""What operators leave to the driver and on disk."""

import os
import time

from arbora.llm import common, language_model, minhash_dedup


def test_components_of_stars_takes_no_round(spark, monkeypatch):
    """Links that hang on one id each are done: no round is spent on seeing that nothing changes."""
    names = []
    monkeypatch.setattr(common, "written", lambda df, name, f=common.written: names.append(name) or f(df, name))
    links = spark.createDataFrame([(1, i) for i in range(2, 9)] + [(20, 21), (30, 30)], "a long, b long")
    out = {r["id"]: r["component"] for r in common.components(links).collect()}
    assert out == {**{i: 1 for i in range(1, 9)}, 20: 20, 21: 20, 30: 30} and "large" not in names


def test_near_duplicates_send_no_table_to_all_tasks(spark, monkeypatch):
    """Tables that happen to be small aren't broadcast: each costs the driver a thread."""
    told = []
    monkeypatch.setattr(minhash_dedup, "written", lambda df, name, f=common.written: told.append(df._jdf.queryExecution().optimizedPlan().toString()) or f(df, name))
    rows = [(i, f"one two three four five six seven eight nine {i % 3} eleven twelve") for i in range(12)]
    minhash_dedup.answers(spark.createDataFrame(rows, "doc_id long, text string"), small=1)
    joins = [line for plan in told for line in plan.split("\n") if "Join " in line]
    assert joins and all("strategy=merge" in line for line in joins)


def test_scoring_leaves_no_shuffle_of_its_counts(spark):
    """What counts are sent by is deleted when it is read, not when the driver next collects garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    of = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}
    docs = spark.createDataFrame([(i, f"a b c d {i}") for i in range(40)], "doc_id long, text string")
    before = of()
    scored = language_model.score(docs)
    for _ in range(50):
        left = of() - before
        if not left:
            break
        time.sleep(0.1)
    # One sum over the counts and one over the lengths may stay: a row for each task.
    assert sum(os.path.getsize(f) for f in left) < 4096 and scored.count() == 40
