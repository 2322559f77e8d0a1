"""Column expressions and small plan fragments shared by the operators."""

from tastemap.functions.buckets import hash_bucket, hash_bucket_sql
from tastemap.functions.numbering import with_global_index, with_running_sum
from tastemap.functions.vectors import spread_vector

__all__ = ["hash_bucket", "hash_bucket_sql", "with_global_index", "with_running_sum", "spread_vector"]
