from refinery.streaming.admission import admit_new_rows, read_accepted, read_aside, read_repeats
from refinery.streaming.incremental import ingest_new_files, merge_new_rows

__all__ = [
    "admit_new_rows", "ingest_new_files", "merge_new_rows", "read_accepted", "read_aside", "read_repeats",
]
