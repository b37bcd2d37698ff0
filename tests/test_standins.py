"""Stand-in tables: how their rows get to the day partitions."""

import pytest

from encore.sources.standins import standin, standin_query
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["cnsm", "logins"])
def test_rows_are_not_shuffled_again_for_the_write(spark, monkeypatch, name):
    """The join or distinct of the table has spread them; the stored rows are those of its query."""
    frame, again = type(spark.range(0)), []
    once = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: again.append(self.columns) or once(self, *a))
    source = SF_SMALL + "/."  # not a folder that other tests have stored
    stored, query = standin(spark, source, name), standin_query(spark, source, name)
    assert not again
    assert stored.count() == query.count() > 0
    assert stored.select(query.columns).exceptAll(query).isEmpty()
