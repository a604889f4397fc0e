"""Reusable DataFrame operators."""

from commitlake.operators.dedupe import keep_latest  # noqa: F401
from commitlake.operators.incremental import (  # noqa: F401
    VersionedTable, incremental_run, upsert, watermark_filter, watermark_value,
)
from commitlake.operators.joins import left_join_dim  # noqa: F401
from commitlake.operators.modes import latest_by, mode_by  # noqa: F401
from commitlake.operators.partitioned import PartitionedTable  # noqa: F401
from commitlake.operators.quality import (  # noqa: F401
    assert_passes, not_null, quality_report, relationships, unique,
)
from commitlake.operators.rank import global_rank, rank_by_value  # noqa: F401
