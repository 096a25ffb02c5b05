"""Steps written to the shared folder can be dropped one by one."""

import pytest

from touchline import session


def test_discard_step_leaves_the_others(spark):
    first = session.materialize(spark.range(5), "step-1")
    second = session.materialize(first.filter("id > 1"), "step-10")
    paths = [step.inputFiles()[0].rsplit("/", 1)[0] for step in (first, second)]
    session.discard_step(first)
    assert second.count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(paths[0]).count()
    assert not any(paths[0].endswith(path.rsplit("/", 1)[-1]) for path in session._written)
    session.discard_step(first)  # nothing left to drop
