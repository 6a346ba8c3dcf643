"""Kept answers of plug-in models: every input asked once, failures as rows, later runs ask the rest."""

import os
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle

from cadenza.operators import calls as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def logging_model(folder, fails=lambda text, attempt: False, raises=False):
    def model(inputs, attempt):
        with open(os.path.join(folder, f"calls-{os.getpid()}"), "a") as log:
            log.writelines(f"{text}\n" for text in inputs)
        if raises and any(fails(t, attempt) for t in inputs):
            raise ConnectionError("down")
        return [None if fails(t, attempt) else t.upper() for t in inputs]
    return model


def calls(folder):
    return Counter(line.strip() for f in os.listdir(folder) for line in open(os.path.join(folder, f)))


@pytest.fixture
def rows(spark):
    texts = ["a", "b", "a", None, "bad", "c", "a", "slow"] * 5 + [""]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(4)


def answered(df):
    return {(r.text, r.out, r.error) for r in df.collect()}


def test_distinct_inputs_are_asked_once_and_failures_later(spark, rows, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    os.mkdir(log)
    model = logging_model(log, lambda t, attempt: t == "bad" or t == "slow" and attempt == 1)
    kept = C.ask(rows, "text", model, store, name="m", attempts=2, slices=3)
    assert calls(log) == {"a": 1, "b": 1, "c": 1, "": 1, "slow": 2, "bad": 2}
    out = C.attach(rows, "text", kept, "out", name="m")
    assert out.count() == rows.count()
    want = {("a", "A", None), ("b", "B", None), ("c", "C", None), ("slow", "SLOW", None), ("bad", None, "no answer"),
            ("", "", None), (None, None, None)}
    assert answered(out) == want
    kept = C.ask(rows, "text", logging_model(log), store, name="m", attempts=2)      # it works now
    assert calls(log) == {"a": 1, "b": 1, "c": 1, "": 1, "slow": 2, "bad": 3}
    assert ("bad", "BAD", None) in answered(C.attach(rows, "text", kept, "out", name="m"))
    again = C.ask(rows, "text", logging_model(log), store, name="m")
    assert calls(log)["bad"] == 3 and again.count() == 6
    C.ask(rows, "text", logging_model(log), store, name="another")                   # a model of its own
    assert calls(log)["bad"] == 4


def test_a_batch_that_raises_is_asked_singly(spark, rows, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    os.mkdir(log)
    model = logging_model(log, lambda t, attempt: t == "bad", raises=True)
    kept = C.ask(rows.coalesce(1), "text", model, store, name="m", attempts=1)
    out = answered(C.attach(rows, "text", kept, "out", name="m"))
    assert ("bad", None, "ConnectionError: down") in out and ("slow", "SLOW", None) in out and len(out) == 7


def test_no_rows_and_wrong_answers(spark, rows, tmp_path):
    kept = C.ask(rows.where("false"), "text", lambda inputs, attempt: [], str(tmp_path / "none"), name="m")
    assert kept.count() == 0
    kept = C.ask(rows, "text", lambda inputs, attempt: [["1"]] * (len(inputs) + 1), str(tmp_path / "long"), name="m", attempts=1)
    assert kept.where("error IS NULL").count() == 0 and kept.count() == 6
