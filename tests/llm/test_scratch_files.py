"""Files of steps that have ended do not stay on the disks."""

import glob
import random
import time

from pyspark.sql import functions as F

from ledger_spark.llm import tables
from ledger_spark.llm.suffix_dedup import remove_repeats


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {
        f for d in manager.localDirsString() for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)
    }


def test_shuffle_files_go_with_the_write(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda _: str(tmp_path))
    before, held = shuffle_files(spark), spark.conf.get(tables.SHUFFLE_CLEANUP)
    # The frame is held, so that nothing goes because it was collected as garbage.
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    got = tables.scratch(counted, "counts")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert sorted(got.collect()) == sorted(counted.collect())
    assert spark.conf.get(tables.SHUFFLE_CLEANUP) == held


def test_only_the_runs_found_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda _: str(tmp_path))
    pick = random.Random(4)
    same = "".join(pick.choices("abcdef ", k=400))
    texts = [f"{pick.random()} {same[i:300 + i]} {pick.random()}" for i in range(0, 100, 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = remove_repeats(docs)
    kinds = {p.name.removeprefix("llm-").rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert kinds == {"shared-ids", "repeats"}
    kept = {r.doc_id: r.kept.decode() for r in cut.collect()}
    assert kept[0] == texts[0] and len(kept[1]) < len(texts[1])
