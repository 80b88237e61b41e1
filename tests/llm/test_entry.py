"""The driver contract finds every numbered query while the subpackage is there."""

import __spark_entry__


def test_all_numbered_queries_are_registered():
    numbers = {n[2:].split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")}
    assert numbers == {str(k) for k in range(1, 14)} and "pipeline" in __spark_entry__.queries()
    assert {"op2_line_dedup", "op4_url_filter", "op8_substring_dedup"} <= set(__spark_entry__.oracle_sql())
