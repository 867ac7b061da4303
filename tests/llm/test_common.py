"""What the operators share: staged tables."""

import gc

from voltweave.llm.common import discard, staged


def test_staging_frees_what_the_driver_no_longer_needs(spark):
    jvm = spark._jvm
    dead = jvm.java.util.ArrayList()
    seen = jvm.java.lang.ref.WeakReference(dead)
    del dead
    gc.collect()
    out = staged(spark.range(3), "freed")
    assert seen.get() is None
    assert sorted(r[0] for r in out.collect()) == [0, 1, 2]
    discard(out)
