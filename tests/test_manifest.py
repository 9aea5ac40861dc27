"""Model versions: compare-and-set, failures, champions."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from multiprocessing.pool import ThreadPool
from types import SimpleNamespace

import pytest

from tickwell.plans import learning
from tickwell.sources import manifest, registry
from tickwell.sources.manifest import Manifest, Stale, Version, commit, promote, put_manifest, read_manifest


def added(version):
    made = Version(version, f"entries/{version}", "2024-01-01T00:00:00")
    return lambda now: now.with_version(made)


def test_empty(spark, tmp_path):
    root = str(tmp_path / "none")
    assert read_manifest(spark, root) == Manifest()
    assert registry.entries(spark, root).count() == registry.versions(spark, root).count() == 0
    with pytest.raises(ValueError):
        registry.load(spark, root, [], ())


def test_a_number_is_given_once(spark, tmp_path):
    root = str(tmp_path)
    first = Manifest(number=1, champion=7)
    assert put_manifest(spark, root, first)
    assert not put_manifest(spark, root, Manifest(number=1, champion=8))
    assert read_manifest(spark, root) == first
    assert [p.name for p in (tmp_path / "manifest").iterdir() if not p.name.startswith(".")] == ["000000000001.json"]


@pytest.mark.parametrize("move", [manifest._linked, manifest._renamed])
def test_a_name_is_given_once_either_way(spark, tmp_path, move):
    for name in "ab":
        (tmp_path / name).write_text(name)
    target = str(tmp_path / "target")
    assert move(spark, str(tmp_path / "a"), target)
    assert not move(spark, str(tmp_path / "b"), target)
    assert (tmp_path / "target").read_text() == "a"


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_commits_side_by_side_are_all_kept(spark, tmp_path, scheme):
    root = scheme + str(tmp_path)
    with ThreadPool(6) as pool:
        pool.map(lambda v: commit(spark, root, added(v)), range(12))
    last = read_manifest(spark, root)
    assert [v.version for v in last.versions] == list(range(12)) and last.number == 12


def test_a_late_writer_applies_its_change_to_what_it_finds(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    commit(spark, root, added(0))
    real, raced = manifest.put_manifest, []

    def overtaken(session, at, wanted):
        if not raced:
            other = added(5)(read_manifest(session, at))
            raced.append(real(session, at, replace(other, number=wanted.number)))
        return real(session, at, wanted)

    monkeypatch.setattr(manifest, "put_manifest", overtaken)
    commit(spark, root, added(1))
    assert raced == [True]
    assert [v.version for v in read_manifest(spark, root).versions] == [0, 1, 5]


def test_first_version_is_champion_and_replaced_ones_keep_their_parent(spark, tmp_path):
    root = str(tmp_path)
    commit(spark, root, added(3))
    commit(spark, root, added(4))
    assert promote(spark, root, 4, instead_of=3).champion == 4
    again = commit(spark, root, added(4))
    assert [(v.version, v.parent) for v in again.versions] == [(3, None), (4, 3)] and again.champion == 4


def test_promotion_needs_the_champion_it_was_judged_against(spark, tmp_path):
    root = str(tmp_path)
    for v in (0, 1, 2):
        commit(spark, root, added(v))
    promote(spark, root, 1, instead_of=0)
    with pytest.raises(Stale):
        promote(spark, root, 2, instead_of=0)
    with pytest.raises(ValueError):
        promote(spark, root, 9, instead_of=1)
    assert read_manifest(spark, root).champion == 1


def test_a_save_that_fails_is_not_listed(spark, tmp_path):
    root = str(tmp_path)

    class Broken:
        def write(self):
            raise OSError("disk")

    trained = SimpleNamespace(metrics={}, direction={"A": Broken()}, volatility={})
    with pytest.raises(OSError):
        registry.save(spark, trained, root, 1, datetime(2024, 1, 1))
    assert registry.latest_version(spark, root) is None


@pytest.mark.parametrize(
    "new,old,wins", [(0.6, 0.5, True), (0.5, 0.5, True), (0.4, 0.5, False), (0.4, None, True), (None, 0.5, False)]
)
def test_challenger_wins_unless_worse(monkeypatch, new, old, wins):
    said = {"new": new, "old": old}
    monkeypatch.setattr(learning, "held_out_accuracy", lambda rows, fitted: said[fitted["A"]])
    challenger, champion = SimpleNamespace(direction={"A": "new"}), SimpleNamespace(direction={"A": "old"})
    assert learning.not_worse(None, challenger, champion) is wins


def test_challenger_without_a_symbol_of_the_champion_is_worse():
    champion = SimpleNamespace(direction={"A": 1, "B": 2})
    assert not learning.not_worse(None, SimpleNamespace(direction={"A": 1}), champion)
