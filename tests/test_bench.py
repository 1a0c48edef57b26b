from __future__ import annotations

import bench
import lumberline as ll
from lumberline.datasets import document_lines


def test_the_compared_parse_gives_the_same_rows(spark):
    lines = document_lines(spark, "/root/testdata/sf0.001")
    slow, fast = bench.row_at_a_time(lines), ll.parse_logs(lines)
    assert slow.columns == fast.columns
    assert slow.exceptAll(fast).count() == fast.exceptAll(slow).count() == 0
    assert slow.count() == fast.count() > 0
