from tablework.sources.feeds import (gated, infer_schema, publish_star, read_feed, read_feed_folder, read_star, read_table,
                                    row_gate, typed_projection, write_feed, write_metrics,
                                    write_star, write_star_catalog,
                                    write_star_jdbc, write_table)
from tablework.sources import schemas

__all__ = ["gated", "infer_schema", "publish_star", "read_feed", "read_feed_folder", "read_star", "read_table", "row_gate", "typed_projection",
           "write_feed", "write_metrics", "write_star", "write_star_catalog", "write_star_jdbc", "write_table",
           "schemas"]
