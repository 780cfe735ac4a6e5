import zipfile

from vitals import fixtures as fx


def test_written_archives_are_compressed(spark, tmp_path):
    fx.write_archives(spark, "/root/testdata/sf0.001", str(tmp_path))
    found = list(tmp_path.glob("*/*.zip"))
    with zipfile.ZipFile(found[0]) as archive:
        entry = archive.infolist()[0]
    assert entry.compress_size < entry.file_size / 2
