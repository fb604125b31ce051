"""Versions of a set of tables, published together."""

import pytest

from transitlake.operators.quality import Check, failures_after_write, observed
from transitlake.sources.versions import Versions, published


def write(versions, spark, number):
    version = versions.begin()
    for name in ("a", "b"):
        spark.createDataFrame([(number,)], "i int").write.parquet(versions.path(version, name))
    return version


def test_readers_follow_what_is_published(spark, tmp_path):
    root = str(tmp_path / "marts")
    versions = Versions(spark, root)
    with pytest.raises(FileNotFoundError):
        published(spark, root, "a")
    done = []
    for number in range(4):
        version = write(versions, spark, number)
        if number:
            # written, but not in use yet
            assert published(spark, root, "a").first().i == number - 1
        versions.publish(version, ["a", "b"])
        done.append(version)
        assert {published(spark, root, n).first().i for n in "ab"} == {number}
    # the last two stay for readers that are under way
    assert sorted(versions._folders()) == sorted(done[-2:])


def test_failed_and_unfinished_versions(spark, tmp_path):
    root = str(tmp_path / "marts")
    versions = Versions(spark, root)
    good = write(versions, spark, 1)
    versions.publish(good, ["a", "b"])
    failed, later = write(versions, spark, 2), write(versions, spark, 3)
    assert published(spark, root, "a").first().i == 1
    # a pointer whose write broke off
    (tmp_path / "marts" / "_published" / "9.json.tmp").write_text('{"vers')
    assert versions.current()["version"] == good
    newest = write(versions, spark, 4)
    versions.publish(later, ["a", "b"])
    assert published(spark, root, "a").first().i == 3
    assert failed not in versions._folders() and newest in versions._folders()


def test_checks_are_counted_while_a_relation_is_written(spark, tmp_path):
    rows = [(1, "a", 5.0), (1, "b", -1.0), (2, None, None), (None, "z", 0.0), (None, "a", 2.0)]
    df = spark.createDataFrame(rows, "k int, t string, v double")
    checks = [
        Check("not_null", "k"),
        Check("unique", "k"),
        Check("accepted_values", "t", ("a", "b")),
        Check("minimum_value", "v", 0),
        Check("not_null", "t"),
    ]
    counting, observation = observed(df, checks)
    counting.write.parquet(str(tmp_path / "t"))
    found = failures_after_write(spark.read.parquet(str(tmp_path / "t")), checks, observation)
    assert found == {
        ("not_null", "k"): 2, ("unique", "k"): 1, ("accepted_values", "t"): 1,
        ("minimum_value", "v"): 1, ("not_null", "t"): 1,
    }
    assert observed(df, [Check("unique", "k")]) == (df, None)
