"""Session settings for a given amount of data."""

from __future__ import annotations

import math

# A task should hold about this much, which sorts in memory on an executor with
# a few GB per core.
TASK_BYTES = 256 * 1024 * 1024


def settings_for(
    input_bytes: int, cores: int, task_bytes: int = TASK_BYTES
) -> dict[str, str]:
    """Settings for jobs whose largest table has ``input_bytes``.

    Adaptive execution merges shuffle partitions but cannot split all of them,
    so the number to start with must fit the largest shuffle. Everything else
    stays at Spark's default: adaptive execution with skew-join handling, and
    broadcasts only below the size threshold.
    """
    tasks = math.ceil(input_bytes / task_bytes)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.shuffle.partitions": str(max(2 * cores, tasks)),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }
