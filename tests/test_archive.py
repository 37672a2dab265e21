import hashlib

import pytest

from pitlake import jobs
from pitlake.plans import archive
from pitlake.sources.store import Store

GAMES = "game_pk string, season_year int, game_date string, game_type string, is_final boolean, home_team_id string, away_team_id string"


def test_digests_a_chunk_at_a_time(tmp_path, monkeypatch):
    """No more than a chunk is asked for at once, whatever the size of the file."""
    body = bytes(range(256)) * 5000
    (tmp_path / "a b%.bin").write_bytes(body)
    asked, opened = [], archive._opened

    class Watched:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read(self, n):
            asked.append(n)
            return self.f.read(n)

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def open_input_stream(self, path):
            return Watched(self.fs.open_input_stream(path))

    monkeypatch.setattr(archive, "_opened", lambda p: (Files(opened(f"file:{tmp_path}")[0]), p))
    assert archive.digest(str(tmp_path / "a b%.bin"), 1000) == (len(body), hashlib.sha256(body).hexdigest())
    assert set(asked) == {1000} and len(asked) == -(-len(body) // 1000) + 1


@pytest.mark.parametrize("root", ["store+v1", "a/store", "s(1).x"])
def test_keys_are_below_the_whole_root(spark, tmp_path, root):
    """Roots with characters of patterns, and a folder inside that has the root's own name."""
    where = tmp_path / root
    for inside in ("games", f"{root.split('/')[-1]}/games"):
        spark.range(3).coalesce(1).write.parquet(f"{where}/{inside}/season_year=2023")
    got = {r["key"].rsplit("/", 1)[0]: r["rows"] for r in archive.discover(spark, str(where), 2025).collect()}
    assert got == {"archive/games/season_year=2023": 3, f"archive/{root.split('/')[-1]}/games/season_year=2023": 3}


def test_copies_are_verified(tmp_path, monkeypatch):
    source, target = tmp_path / "s.bin", tmp_path / "t" / "u.bin"
    source.write_bytes(b"content" * 1000)
    size, sha = archive.digest(f"file:{source}")
    copy = lambda **more: archive.copy_verified(f"file:{source}", f"file:{target}", size, sha, **more)
    assert copy() == "copied" and target.read_bytes() == source.read_bytes()
    assert copy() == "present"
    target.write_bytes(b"other")
    assert copy() == "conflict" and target.read_bytes() == b"other"
    assert copy(overwrite=True) == "copied" and target.read_bytes() == source.read_bytes()
    target.unlink()
    source.write_bytes(b"changed since the manifest")
    assert copy() == "mutated" and not list(target.parent.iterdir())
    source.write_bytes(b"content" * 1000)
    real = archive.digest
    monkeypatch.setattr(archive, "digest", lambda p, chunk=1: (0, "") if p.endswith(".part") else real(p))
    assert copy() == "corrupt" and not list(target.parent.iterdir())


def test_archive_job(spark, tmp_path, monkeypatch, capsys):
    """What would be uploaded, the upload, and that again; only live files of the store; a conflict is told."""
    monkeypatch.setattr(jobs, "local_session", lambda: spark)
    store = Store(spark, str(tmp_path / "store"))
    rows = lambda *ids: spark.createDataFrame([(i, y, f"{y}-06-01", "R", True, "1", "2") for i, y in ids], GAMES)
    store.upsert("games", rows(("1", 2023), ("2", 2025)))
    store.upsert("games", rows(("1", 2023)))  # the file before it stays for readers, and is not archived
    args = ["archive", "--store", store.root, "--before-season", "2025", "--target", str(tmp_path / "up")]
    assert jobs.main(args) == 0 and [line.split("\t")[-1] for line in capsys.readouterr().out.splitlines()][1:] == ["upload"]
    assert jobs.main([*args, "--execute"]) == 0 and capsys.readouterr().out.splitlines()[1:] == ["copied\t1"]
    assert jobs.main([*args, "--execute"]) == 0 and capsys.readouterr().out.splitlines()[1:] == ["present\t1"]
    assert jobs.main(args) == 0 and capsys.readouterr().out.splitlines()[1].endswith("skip")
    (file,) = (tmp_path / "up").rglob("*.parquet")
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(b"x")
    assert jobs.main([*args, "--execute"]) == 1 and "conflict" in capsys.readouterr().out
