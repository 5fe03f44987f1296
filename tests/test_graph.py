"""Loads with dependencies: order, failures, retries, limits, cancellation."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from daybook.operators import tables
from daybook.plans import graph, jobs
from daybook.plans.graph import Load


def states(results):
    return {r.table: r.status for r in results}


def test_order():
    loads = {"c": Load(None, ["b"]), "a": Load(None), "b": Load(None, ["a"]), "d": Load(None, ["a", "c"]), "0": Load(None)}
    assert graph.order(loads) == ["0", "a", "b", "c", "d"]
    assert graph.dependants(loads, "b") == {"c", "d"} and graph.dependants(loads, "0") == set()
    with pytest.raises(ValueError, match="need each other.*x.*y"):
        graph.order({"x": Load(None, ["y"]), "y": Load(None, ["x"]), "z": Load(None)})
    with pytest.raises(ValueError, match="not among"):
        graph.order({"x": Load(None, ["lost"])})
    assert graph.order({}) == []


def test_a_table_is_loaded_behind_what_it_needs(spark, db):
    begun = []

    def writer(name, *needed):
        def write():
            begun.append(name)
            for table in needed:
                assert spark.table(f"{db}.{table}").count() > 0
            tables.full_overwrite(spark.range(3), f"{db}.{name}")
        return write

    jobs.create_audit_table(spark, f"{db}.audit")
    loads = {"wide": Load(writer("wide", "facts", "people"), ["facts", "people"]), "facts": Load(writer("facts")),
             "people": Load(writer("people")), "narrow": Load(writer("narrow", "wide"), ["wide"])}
    results = graph.load_dependent(spark, f"{db}.audit", loads)
    assert [r.table for r in results] == ["facts", "people", "wide", "narrow"]
    assert set(states(results).values()) == {jobs.SUCCEEDED} and begun[2:] == ["wide", "narrow"]
    assert spark.table(f"{db}.audit").count() == 4


def test_what_needs_a_failed_table_is_skipped_and_the_rest_goes_on(spark, db):
    done = []
    jobs.create_audit_table(spark, f"{db}.audit")

    def broken():
        raise ValueError("the source didn't answer")

    loads = {"base": Load(broken), "other": Load(lambda: done.append("other")), "next": Load(lambda: done.append("next"), ["base"]),
             "last": Load(lambda: done.append("last"), ["next", "other"]), "free": Load(lambda: done.append("free"), ["other"])}
    results = {r.table: r for r in graph.load_dependent(spark, f"{db}.audit", loads, at_once=1)}
    assert {t: r.status for t, r in results.items()} == {
        "base": jobs.FAILED, "other": jobs.SUCCEEDED, "next": graph.SKIPPED, "last": graph.SKIPPED, "free": jobs.SUCCEEDED}
    assert done == ["other", "free"] and results["next"].info == "needs base" and results["last"].info == "needs next"
    audit = {r["table_name"]: (r["status"], r["info"]) for r in spark.table(f"{db}.audit").collect()}
    assert audit["base"] == ("0", "the source didn't answer") and audit["last"] == ("2", "needs next")


def test_retries(spark):
    calls = []

    def third_time():
        calls.append(time.time())
        if len(calls) < 3:
            raise OSError("not yet")

    run = graph.Run(spark, {"t": Load(third_time, retries=2, pause=0.1), "u": Load(lambda: None, ["t"])})
    assert states(run.execute()) == {"t": jobs.SUCCEEDED, "u": jobs.SUCCEEDED}
    assert run.attempts == {"t": 3, "u": 1} and calls[2] - calls[1] >= 0.2
    calls.clear()
    run = graph.Run(spark, {"t": Load(third_time, retries=1), "u": Load(lambda: None, ["t"])})
    assert states(run.execute()) == {"t": jobs.FAILED, "u": graph.SKIPPED}


def job(spark, begun=None):
    def write():
        if begun is not None:
            begun.set()
        spark.range(10**14).selectExpr("sum(hash(id))").collect()  # ends in no test's time
    return write


def test_a_load_beyond_its_limit_is_interrupted(spark):
    loads = {"late": Load(job(spark), limit=2.0), "behind": Load(lambda: None, ["late"]),
             "other": Load(lambda: spark.range(10).count())}
    began = time.time()
    results = {r.table: r for r in graph.Run(spark, loads).execute()}
    assert time.time() - began < 60
    assert results["late"].info == "took more than 2.0 s" and results["behind"].status == graph.SKIPPED
    assert results["other"].status == jobs.SUCCEEDED


def test_a_cancelled_load_ends_and_other_jobs_do_not(spark):
    begun = threading.Event()
    run = graph.Run(spark, {"long": Load(job(spark, begun), retries=3), "behind": Load(lambda: None, ["long"]),
                            "other": Load(lambda: [spark.range(1000).repartition(3).count() for _ in range(10)])})
    thread = threading.Thread(target=run.execute)
    thread.start()
    assert begun.wait(30)
    time.sleep(1)
    run.cancel("long", "stopped by hand")
    thread.join(60)
    assert not thread.is_alive()
    assert {t: (r.status, r.info) for t, r in run.results.items() if t != "other"} == {
        "long": (jobs.FAILED, "stopped by hand"), "behind": (graph.SKIPPED, "needs long")}
    assert run.results["other"].status == jobs.SUCCEEDED and run.attempts["long"] == 1


def test_a_load_cancelled_before_it_begins(spark):
    run = graph.Run(spark, {"a": Load(lambda: None), "b": Load(lambda: None, ["a"]), "c": Load(lambda: None, ["b"])})
    run.cancel("b")
    assert states(run.execute()) == {"a": jobs.SUCCEEDED, "b": graph.SKIPPED, "c": graph.SKIPPED}
