"""Column functions."""

from .murmur2 import murmur2_hash, murmur2_partition
from .text import (md5_pick, md5_uuid, message_key, record_id,
                   title_case, utf8_or_null)

__all__ = ["murmur2_hash", "murmur2_partition", "md5_pick", "md5_uuid", "message_key", "record_id", "title_case",
           "utf8_or_null"]
