import time
from pathlib import Path

import pytest

from partloom.errors import ConfigError, StorageError
from partloom.sources import storage


def put(folder, *names):
    root = Path(folder.removeprefix("file:"))
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    return root


@pytest.mark.parametrize(
    "names, found",
    [
        ([], False),
        (["x/_SUCCESS", "x/.part.crc"], False),
        (["x/_staging-1/part-0", "x/.hidden/part-0"], False),
        (["x/part-0"], True),
        (["x/a/b/part-0", "x/_SUCCESS"], True),
        (["x/_k=1/part-0"], True),
        (["x y/part-0"], False),
    ],
)
def test_has_objects(spark, folder, names, found):
    put(folder, *names)
    assert storage.has_objects(spark, f"{folder}x") is found
    assert storage.has_objects(spark, f"{folder}x/") is found
    assert storage.has_objects(spark, None) is False


def test_vacant(spark, folder):
    root = put(folder, "x/_SUCCESS")
    (root / "hollow").mkdir()
    assert not storage.is_vacant(spark, f"{folder}x")
    assert storage.is_vacant(spark, f"{folder}hollow") and storage.is_vacant(spark, f"{folder}nowhere")


def test_delete_tree(spark, folder):
    root = put(folder, "x/a/b/c", "x/_SUCCESS", "xy/a")
    storage.delete_tree(spark, f"{folder}x")
    storage.delete_tree(spark, f"{folder}nowhere")
    storage.delete_tree(spark, None)
    assert [p.name for p in root.iterdir()] == ["xy"]


def test_swap(spark, folder):
    root = put(folder, "old/a", "old/sub/b", "new/c")
    with storage.swapped(spark, f"{folder}new", f"{folder}old/"):
        assert (root / "old/c").exists()
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*")) == ["old", "old/c"]


def test_swap_where_nothing_was(spark, folder):
    root = put(folder, "new/c")
    with storage.swapped(spark, f"{folder}new", f"{folder}deep/er/old/"):
        pass
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*")) == ["deep", "deep/er", "deep/er/old", "deep/er/old/c"]


def test_failed_move_brings_the_old_files_back(spark, folder):
    root = put(folder, "old/a")
    with pytest.raises(StorageError):
        with storage.swapped(spark, f"{folder}nowhere", f"{folder}old"):
            pass
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*")) == ["old", "old/a"]


def test_failed_block_brings_the_old_files_back(spark, folder):
    root = put(folder, "old/a", "new/c")
    for staged in (f"{folder}new", None):
        with pytest.raises(KeyError), storage.swapped(spark, staged, f"{folder}old"):
            put(folder, "old/made-meanwhile")
            raise KeyError
        assert (root / "old/a").exists() and not (root / "old/c").exists()


def test_overlapping(spark):
    places = ["file:/a/b", "file:/a/b/c/d", "file:/a", "file:/x/bc"]
    assert storage.overlapping(spark, places, ["/a/b/c/", "/x/b"]) == places[:3]


def test_one_file_only(spark, folder):
    put(folder, "x/a.sql", "x/b.sql")
    assert storage.only_file(spark, f"{folder}x/a.sql").endswith("/x/a.sql")
    for other in ("x", "x/*.sql", "x/c.sql"):
        with pytest.raises(ConfigError):
            storage.only_file(spark, f"{folder}{other}")


def test_same_place(spark):
    assert storage.same_place(spark, "file:/a/b", "/a/b/")
    assert not storage.same_place(spark, "file:/a/b", "file:/a/c")


def test_holds(spark):
    assert storage.holds(spark, "file:/a", "/a/b/") and storage.holds(spark, "/a/b", "file:/a/b/")
    assert not storage.holds(spark, "/a/b", "/a/bc") and not storage.holds(spark, "/a/b/c", "/a/b")


def test_shared_folder_must_be_named(spark):
    class Bare:
        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ConfigError, match="spark.checkpoint.dir"):
        storage.shared_folder(Bare)


def test_threads_have_job_properties_of_their_own(spark):
    context = spark.sparkContext
    context.setLocalProperty("outer", "kept")

    def work(i):
        context.setLocalProperty("inner", str(i))
        time.sleep(0.05)
        return context.getLocalProperty("inner"), context.getLocalProperty("outer")

    try:
        assert storage.for_each(spark, work, range(64)) == [(str(i), "kept") for i in range(64)]
    finally:
        context.setLocalProperty("outer", None)


def test_results_keep_their_order_and_errors_come_through(spark):
    assert storage.for_each(spark, lambda i: i * 2, range(100)) == list(range(0, 200, 2))
    assert storage.for_each(spark, str, []) == []
    with pytest.raises(ZeroDivisionError):
        storage.for_each(spark, lambda i: 1 // i, range(10))
