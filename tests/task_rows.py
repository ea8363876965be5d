"""What the tasks of a session's stages have read, from Spark's own status store."""

from __future__ import annotations

from contextlib import contextmanager


def _stages(spark):
    sc = spark.sparkContext
    doubles = sc._gateway.new_array(sc._jvm.double, 0)
    found = sc._jsc.sc().statusStore().stageList(None, False, False, doubles, None)
    return [found.apply(i) for i in range(found.size())]


@contextmanager
def stages_of(spark):
    """A list that holds the stages run inside the block, after it."""
    before = {s.stageId() for s in _stages(spark)}
    new = []
    yield new
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    new += [s for s in _stages(spark) if s.stageId() not in before and s.numCompleteTasks() > 0]


def shuffled_rows(spark, stage) -> list[int]:
    """Rows that each task of a stage read from shuffles."""
    tasks = spark.sparkContext._jsc.sc().statusStore().taskList(stage.stageId(), stage.attemptId(), 10_000)
    found = []
    for i in range(tasks.size()):
        metrics = tasks.apply(i).taskMetrics()
        if metrics.isDefined():
            found.append(metrics.get().shuffleReadMetrics().recordsRead())
    return found
