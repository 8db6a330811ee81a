import os
import time

from ledgerline.llm.common import Scratch
from ledgerline.session import checkpoint_dir


def test_left_over_intermediates_expire(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    old, other, fresh = Scratch(spark, "expiry"), Scratch(spark, "expiry-x"), Scratch(spark, "expiry")
    for s in (old, other, fresh):
        s.save(spark.range(3))
    long_ago = time.time() - 90 * 3600
    for s in (old, other):
        p = s.root.removeprefix("file:")
        assert p.startswith(base)
        os.utime(p, (long_ago, long_ago))
    Scratch(spark, "expiry")
    assert [os.path.exists(s.root.removeprefix("file:")) for s in (old, other, fresh)] == [False, True, True]
