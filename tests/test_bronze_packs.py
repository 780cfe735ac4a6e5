"""Small archives share files in bronze."""

import hashlib
import os
import zipfile

import pytest

from vitals.plans.pipeline import Lake, land, pending
from vitals.sources import archives


def put(folder, user, name="export.zip", text="<HealthData/>", kind=zipfile.ZIP_DEFLATED):
    (folder / user).mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / user / name, "w", kind) as z:
        z.writestr("export.xml", text)
    return (folder / user / name).read_bytes()


def files_below(folder):
    return [os.path.join(at, name) for at, _, names in os.walk(folder) for name in names]


@pytest.fixture
def landed(spark, tmp_path):
    source, lake = tmp_path / "a b#1.pack" / "in", Lake(str(tmp_path / "a b#1.pack" / "lake"))
    want = {f"ü {i}": put(source, f"ü {i}", text=f"<HealthData><Me n='{i}'/></HealthData>") for i in range(60)}
    want["large"] = put(source, "large", text="x" * archives.SMALL_BYTES, kind=zipfile.ZIP_STORED)
    (source / "raw").mkdir()
    (source / "raw" / "export.zip").write_bytes(b"no archive")
    land(spark, lake, str(source))
    return source, lake, want | {"raw": b"no archive"}


def test_small_archives_share_files_and_are_read_back(spark, landed):
    source, lake, want = landed
    rows = pending(spark, lake).collect()
    assert len(rows) == len(want)
    for row in rows:
        with archives.open_archive(row.archive) as archive:
            content = archive.read()
        assert content == want[row.user_id] and row.sha256 == hashlib.sha256(content).hexdigest()
    own = sorted(os.path.basename(os.path.dirname(path)) for path in files_below(lake.bronze) if path.endswith(".zip"))
    assert own == ["large", "raw"]  # too large, or to be put right where it is
    assert len(files_below(lake.bronze)) - 2 < 60 and not os.path.exists(f"{lake.bronze}/%C3%BC%201")


def test_packs_are_of_bounded_size_and_cut_ones_are_noticed(tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "PACK_BYTES", 100)
    pack = archives._Pack(str(tmp_path / "packs"))
    places = [pack.add(bytes([i]) * 60, "0" * 64) for i in range(5)]
    pack.close()
    assert len({place.split("#")[0] for place in places}) == 3 and len(list((tmp_path / "packs").iterdir())) == 3
    for i, place in enumerate(places):
        with archives.open_archive(place) as archive:
            assert archive.read() == bytes([i]) * 60
    (tmp_path / "packs" / places[1].split("#")[0].rsplit("/", 1)[1]).write_bytes(b"x" * 90)
    with pytest.raises(OSError, match="cut short"), archives.open_archive(places[1]):
        pass


def test_copies_leave_no_packs(spark, landed):
    source, lake, want = landed
    before = sorted(path for path in files_below(lake.bronze) if path.endswith((".pack", ".zip", ".part")))
    for user in want:
        (source / user / "copy.zip").write_bytes(want[user])
    assert land(spark, lake, str(source)).count() == 0
    assert sorted(path for path in files_below(lake.bronze) if path.endswith((".pack", ".zip", ".part"))) == before
