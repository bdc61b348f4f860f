"""General DataFrame operators: validation, keep-one deduplication, ranking without a single-task sort, staging."""

from .increment import KeyedState
from .keep_one import keep_earliest, keep_latest
from .quality import Check, Checked, First, Known, evaluated_once, reject_summary
from .ranking import number_rows, numbered, rank_within, ranks_within
from .staging import Keep, Stage, not_kept, shared_folder

__all__ = [
    "Check",
    "Checked",
    "First",
    "Keep",
    "KeyedState",
    "Known",
    "Stage",
    "evaluated_once",
    "keep_earliest",
    "keep_latest",
    "not_kept",
    "number_rows",
    "numbered",
    "rank_within",
    "ranks_within",
    "reject_summary",
    "shared_folder",
]
