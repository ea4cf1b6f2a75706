"""Sources and sinks.

Canonical columns the operators read (names are the contract):

* sales fact:   line keys..., order_date DATE, sku, channel_id | ch, qty, revenue[, cost]
* products:     sku, cat, collection[, unit_cost]
* channels:     channel_id, ch
* collections:  order_id, order_date, raw_delay | delay_days, amount
* order lookup: order_id, ch
* charges:      charge_date, cc_id, nature, amount
* cost centres: cc_id, cc_name, payroll_base
* budget:       yr, mo, type, ch, cat, cc_id, amount, margin_pc
"""

from closebook.sources.schemas import STAR_SCHEMAS, STAR_TABLES
from closebook.sources.star import (check_inputs, read_star, table_row_counts, write_csv,
                                    write_star)
from closebook.sources.testdata import LINE_KEYS, TestData

__all__ = ["STAR_SCHEMAS", "STAR_TABLES", "check_inputs", "read_star", "table_row_counts",
           "write_csv", "write_star", "LINE_KEYS", "TestData"]
