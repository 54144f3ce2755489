"""Frame-to-frame building blocks: keyed upserts, skew-aware joins, staging, row ids."""
