"""The queue of failed ids over several runs."""

from datetime import datetime, timedelta

from adloom.operators.retries import FIELDS, due, queue_after

START = datetime(2024, 1, 1)
ON = ["entity", "id"]


def test_failures_wait_and_hopeless_ones_stay(spark):
    def ids(*names):
        return spark.createDataFrame([("ads", n) for n in names], "entity string, id string")

    def failures(**classes):
        rows = [("ads", n, c) for n, of in classes.items() for c in of]
        return spark.createDataFrame(rows, "entity string, id string, class string")

    def asked(queue, wanted, at):
        return sorted(r["id"] for r in due(queue, wanted, at, ON).collect())

    queue = spark.createDataFrame([], f"entity string, id string, {FIELDS}")
    wanted = ids("a", "b", "c", "d", "d", None)
    assert asked(queue, wanted, START) == ["a", "b", "c", "d"]
    told = failures(b=["retryable", "fatal"], c=["retryable"])
    queue = queue_after(queue, due(queue, wanted, START, ON), ids("a", "a"), told, START, ON)
    state = {r["id"]: (r["attempts"], r["class"], r["next_try"]) for r in queue.collect()}
    minute = START + timedelta(seconds=60)
    # d failed without a word, so it is asked for again
    assert state == {"b": (1, "fatal", None), "c": (1, "retryable", minute), "d": (1, "retryable", minute)}

    assert asked(queue, wanted, START + timedelta(seconds=59)) == ["a"]
    assert asked(queue, ids("e"), minute) == ["c", "d", "e"]
    queue = queue_after(queue, due(queue, ids("e"), minute, ON), ids("c", "e"), failures(d=["retryable"]), minute, ON)
    state = {r["id"]: (r["attempts"], r["class"], r["next_try"]) for r in queue.collect()}
    assert state == {"b": (1, "fatal", None), "d": (2, "retryable", minute + timedelta(seconds=90))}
    assert asked(queue, ids("b"), minute + timedelta(days=9)) == ["d"]
