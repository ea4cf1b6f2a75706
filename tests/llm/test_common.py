import time

from closebook.llm.common import CLEANUP, materialize


def test_shuffle_files_go_when_an_intermediate_is_written(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv
    def shuffled():
        blocks = env.get().blockManager().diskBlockManager().getAllBlocks()
        return {x for x in (blocks.apply(i).name() for i in range(blocks.size())) if x.startswith("shuffle_")}

    before, conf = shuffled(), spark.conf.get(CLEANUP)
    df = spark.range(10_000).repartition(5, "id")
    written = materialize(df, "shuffled")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(CLEANUP) == conf
    assert written.count() == df.count() == 10_000
