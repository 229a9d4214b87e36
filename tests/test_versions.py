"""Publishing a load: all tables at once, or none."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.plans.star import build_star, denormalize
from starmart.sources import catalog
from starmart.sources.versions import NothingPublished, Versions
from starmart.spec import Dimension, Reference, Star, columns

STAR = Star(
    dimensions=(Dimension("d", "k", columns("a bigint")), Dimension("e", "m", columns("b string"))),
    fact=Dimension("f", "id", columns("id bigint"), natural_key=True, references=(Reference("k", "d"), Reference("m", "e"))),
)


def source(spark, n):
    return spark.range(n).select("id", (F.col("id") % 5 + n).alias("a"), F.concat(F.lit("t"), F.col("id") % 3).alias("b"))


@pytest.fixture(params=["folder", "tables"])
def versions(request, spark, tmp_path):
    if request.param == "folder":
        yield Versions(spark, str(tmp_path / "star"))
        return
    name = f"db_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, str(tmp_path / "warehouse"))
    yield Versions(spark, str(tmp_path / "star"), name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


class Failing:
    """A store whose write of one table fails halfway."""

    def __init__(self, store, name):
        self.store, self.name = store, name

    def save(self, name, df, replace=False):
        if name == self.name:
            df = df.withColumn("id", F.when(F.col("id") > 50, F.raise_error(F.lit("disk full"))).otherwise(F.col("id")))
        return self.store.save(name, df, replace)

    def load(self, spark, name):
        return self.store.load(spark, name)


def whole(versions):
    return rows(denormalize(STAR, versions.tables()).select("id", "a", "b"))


def files(tmp_path):
    return sorted(f for _, _, names in os.walk(tmp_path) for f in names)


def test_readers_see_whole_loads(spark, versions, tmp_path):
    with pytest.raises(NothingPublished):
        versions.tables()
    with versions.publishing() as store:
        build_star(source(spark, 40), STAR, store, parallel_writes=1)
        with pytest.raises(NothingPublished):
            versions.tables()
    assert whole(versions) == rows(source(spark, 40))
    old = versions.tables()
    before = files(tmp_path)

    with pytest.raises(Exception, match="disk full"), versions.publishing() as store:
        build_star(source(spark, 90), STAR, Failing(store, "f"))
    # Dimensions had been written; nothing of them is left and readers see the old star.
    assert files(tmp_path) == before
    assert whole(versions) == rows(source(spark, 40))
    assert [v for v, _, _ in versions.history()] == [1]

    with versions.publishing() as store:
        build_star(source(spark, 90), STAR, store)
    assert whole(versions) == rows(source(spark, 90))
    # Who took the tables before still reads one load.
    assert rows(denormalize(STAR, old).select("id", "a", "b")) == rows(source(spark, 40))
    assert rows(versions.tables(1)["f"]) == rows(old["f"])
    assert sorted(versions.tables()) == ["d", "e", "f"]


def test_old_versions_are_removed_on_request(spark, versions, tmp_path):
    for n in (10, 20, 30, 40):
        with versions.publishing() as store:
            store.save("f", source(spark, n).select("id"))
    assert versions.remove_old(keep=2) == [1, 2]
    assert [v for v, _, _ in versions.history()] == [3, 4]
    with pytest.raises(NothingPublished):
        versions.tables(1)
    assert versions.tables()["f"].count() == 40 and versions.tables(3)["f"].count() == 30
    assert versions.remove_old(keep=2) == []
    # Numbers go on after a removal.
    with versions.publishing() as store:
        store.save("f", source(spark, 50).select("id"))
    assert [v for v, _, _ in versions.history()] == [3, 4, 5]
    with pytest.raises(ValueError):
        versions.remove_old(keep=0)
    assert sum(os.path.isdir(tmp_path / "star" / "versions" / i) for _, i, _ in versions.history()) in (0, 3)


def test_nothing_written_is_no_version(spark, versions):
    with versions.publishing():
        pass
    assert versions.history() == []


def test_manifest_is_one_file_per_publication(spark, versions, tmp_path):
    with versions.publishing() as store:
        build_star(source(spark, 10), STAR, store)
    written = [f for f in os.listdir(tmp_path / "star" / "manifest") if f.endswith(".parquet")]
    assert len(written) == 1 and versions.manifest().count() == 3
    # Other errors are not taken for a store without versions.
    with pytest.raises(Exception, match="nosuchscheme"):
        Versions(spark, "nosuchscheme://x/y").manifest()
