"""Start-up recovery of files stuck in ``processing``.

Stuck entries are joined to the landing listing on path: a file still there
is set back to ``pending`` (its format re-detected from the bytes, D05) and
goes through the normal ingest again; a missing one is set to ``failed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import constants as K
from . import manifest as M


def recover(current_df: DataFrame, landing: DataFrame, as_of: Column,
            older_than_seconds: int = K.STUCK_AFTER_SECONDS) -> DataFrame:
    """Rows: content_hash, path, new_status, reason, format (null when gone).

    ``landing`` = (path, key, content, length) of objects present now.
    """
    st = M.stuck(current_df, as_of, older_than_seconds).select("content_hash", "path", "source")
    found = landing.join(st.select("path"), "path", "left_semi").select(
        "path", C.detect_format("key", "content").alias("format"))
    j = st.join(found, "path", "left")
    gone = F.col("format").isNull()
    return j.select(
        "content_hash", "path", "source",
        F.when(gone, F.lit(K.FAILED)).otherwise(F.lit(K.PENDING)).alias("new_status"),
        F.when(gone, F.lit(K.MSG_UNREADABLE)).alias("reason"),
        "format")


def recovery_log_rows(recovered: DataFrame, at: Column, batch_id: int) -> DataFrame:
    """Manifest transitions for the recovery decisions."""
    # seq -1: at the same instant, the decision precedes the re-ingest's own transitions
    return M.log_rows(recovered, F.col("new_status"), at, -1, batch_id, F.col("reason"))
