"""Writers: batch tables (replace/append), generic files, warehouses, feeds."""

from ledgerline.sinks.writers import (
    write_batch, write_any, write_warehouse, write_feeds, land_batch,
)

__all__ = ["write_batch", "write_any", "write_warehouse", "write_feeds", "land_batch"]
