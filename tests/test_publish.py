"""Claims, and publishes that are refused, interrupted or overlap."""

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest

import fixtures
from test_columns import RUN
from tierlake.plans import bronze
from tierlake.quality.gate import QualityGateError
from tierlake.sources import claims, files, publish, sinks
from tierlake.sources.claims import ClaimedError, claimed
from tierlake.sources.entities import landed

POSTS = [post for post in fixtures.POSTS if post["userId"] is not None]
DAY = "bronze/posts/ano=2024/mes=01/dia=05"


@pytest.fixture
def posts(tmp_path):
    """Specs of a good load of 5 posts, of another one of 2, and of one that the gate stops."""
    loads = {"good": POSTS, "other": POSTS[:2], "bad": fixtures.POSTS}
    return {name: landed(fixtures.land(tmp_path / name, {"posts": rows}))["posts"] for name, rows in loads.items()}


def rows(spark, base):
    return sinks.read_partitions(spark, f"{base}/bronze/posts").count()


def leftovers(base):
    return sorted(str(path.relative_to(base)) for path in base.glob("_*/**/*.parquet")) + sorted(
        str(path.relative_to(base)) for path in base.glob("_claims/**/*") if path.is_file() and not path.name.endswith(".crc")
    )


def refuse(monkeypatch, target, times=1):
    """Moves to the target fail, so many times."""
    move, left = files.move, [times]

    def refused(spark, source, goal):
        if goal.endswith(target) and left[0]:
            left[0] -= 1
            raise OSError(f"no {goal}")
        move(spark, source, goal)

    monkeypatch.setattr(files, "move", refused)


def test_a_refused_move_leaves_the_old_day(spark, posts, tmp_path, monkeypatch):
    base = tmp_path / "lake"
    bronze.run_bronze_job(spark, posts["good"], str(base), RUN)
    refuse(monkeypatch, "dia=05")
    with pytest.raises(OSError, match="no "):
        bronze.run_bronze_job(spark, posts["other"], str(base), RUN)
    assert rows(spark, base) == 5 and leftovers(base) == []
    assert bronze.run_bronze_job(spark, posts["other"], str(base), RUN).rows == rows(spark, base) == 2


def test_a_run_that_dies_between_the_moves_is_mended_by_one_that_the_gate_stops(spark, posts, tmp_path, monkeypatch):
    base = tmp_path / "lake"
    bronze.run_bronze_job(spark, posts["good"], str(base), RUN)
    refuse(monkeypatch, "dia=05", times=2)
    with pytest.raises(OSError):
        bronze.run_bronze_job(spark, posts["other"], str(base), RUN)
    assert not (base / DAY).exists()
    with pytest.raises(QualityGateError):
        bronze.run_bronze_job(spark, posts["bad"], str(base), RUN)
    assert rows(spark, base) == 5 and leftovers(base) == []


def test_a_day_written_without_a_claim_is_not_nested(spark, posts, tmp_path, monkeypatch):
    """Something makes the target between the two moves: its data stays, and stays readable."""
    base, swap = tmp_path / "lake", files.move
    bronze.run_bronze_job(spark, posts["good"], str(base), RUN)
    bronze.run_bronze_job(spark, posts["other"], str(tmp_path / "elsewhere"), RUN)

    def late(spark, source, goal):
        if goal.endswith("dia=05") and "_staging" in source:
            swap(spark, str(tmp_path / "elsewhere" / DAY), goal)
            os.rename(base / source.split("lake/", 1)[1], base / DAY / "dia=05")  # as a file system does that checks nothing
        else:
            swap(spark, source, goal)

    monkeypatch.setattr(files, "move", late)
    with pytest.raises(OSError, match="holds no claim"):
        bronze.run_bronze_job(spark, posts["good"], str(base), RUN)
    monkeypatch.setattr(files, "move", swap)
    assert rows(spark, base) == 2 and not (base / DAY / "dia=05").exists()
    assert bronze.run_bronze_job(spark, posts["good"], str(base), RUN).rows == rows(spark, base) == 5
    assert leftovers(base) == []


@pytest.mark.parametrize("how", ["rename", "rewrite"])
def test_overlapping_runs_of_one_day_take_turns(spark, posts, tmp_path, monkeypatch, how):
    base = tmp_path / "lake"
    bronze.run_bronze_job(spark, posts["good"], str(base), RUN, publish=how)
    monkeypatch.setattr(claims, "PATIENCE", 0.5)
    step, met = (publish.Claim.check, [])

    def other_run_meanwhile(claim):
        if not met:
            met.append(1)
            with pytest.raises(ClaimedError):
                bronze.run_bronze_job(spark, posts["good"], str(base), RUN, publish=how)
        step(claim)

    monkeypatch.setattr(publish.Claim, "check", other_run_meanwhile)
    assert bronze.run_bronze_job(spark, posts["other"], str(base), RUN, publish=how).rows == 2
    assert met and rows(spark, base) == 2


def test_runs_of_one_day_at_the_same_time(spark, posts, tmp_path):
    base = tmp_path / "lake"
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(bronze.run_bronze_job, spark, posts[name], str(base), RUN) for name in ["good", "other"] * 4]
        assert sorted(job.result().rows for job in jobs) == [2] * 4 + [5] * 4
    assert rows(spark, base) in (2, 5) and leftovers(base) == []
    assert [path.name for path in (base / "bronze" / "posts").rglob("dia=*")] == ["dia=05"]


def test_an_interrupted_rewrite_is_finished_by_the_next_run(spark, posts, tmp_path, monkeypatch):
    base, write = tmp_path / "lake", sinks.write_partitions
    bronze.run_bronze_job(spark, posts["good"], str(base), RUN, publish="rewrite")

    def dies(df, path, *metrics, **options):
        if "_staging" not in path:
            files.remove(spark, f"{base}/{DAY}")  # half of a commit
            raise RuntimeError("lost driver")
        return write(df, path, *metrics, **options)

    monkeypatch.setattr(sinks, "write_partitions", dies)
    with pytest.raises(RuntimeError, match="lost driver"):
        bronze.run_bronze_job(spark, posts["other"], str(base), RUN, publish="rewrite")
    monkeypatch.setattr(sinks, "write_partitions", write)
    with pytest.raises(QualityGateError):
        bronze.run_bronze_job(spark, posts["bad"], str(base), RUN, publish="rewrite")
    assert rows(spark, base) == 2 and leftovers(base) == []


def test_an_abandoned_claim_is_taken_over(spark, tmp_path, monkeypatch):
    path, mended = str(tmp_path / "claims" / "x"), []
    assert files.create(spark, path, '{"owner": "dead"}') and not files.create(spark, path, "again")
    monkeypatch.setattr(claims, "PATIENCE", 0.3)
    with pytest.raises(ClaimedError):
        with claimed(spark, path):
            pass
    monkeypatch.setattr(claims, "ABANDONED", 0.5)
    time.sleep(0.6)
    with claimed(spark, path, lambda: mended.append(1)) as claim:
        assert claim.held() and mended == [1]
    assert not files.exists(spark, path)


def test_a_claim_that_was_lost_is_noticed(spark, tmp_path):
    path = str(tmp_path / "x")
    with claimed(spark, path) as claim:
        files.remove(spark, path)
        files.create(spark, path, '{"owner": "other"}')
        with pytest.raises(ClaimedError, match="taken over"):
            claim.check()
    assert files.exists(spark, path)


def test_only_known_file_systems_are_trusted_to_rename(spark, tmp_path, monkeypatch):
    assert files.renames_folders(spark, str(tmp_path))
    monkeypatch.setattr(files, "RENAMING", frozenset({"hdfs"}))
    assert not files.renames_folders(spark, str(tmp_path))
    written = bronze.run_bronze_job(spark, replace(landed(fixtures.land(tmp_path / "l", {"posts": POSTS}))["posts"]), str(tmp_path / "lake"), RUN)
    assert written.read(spark).count() == 5
