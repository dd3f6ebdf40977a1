"""Small builders shared by tests."""

import json


def c_batch(spark, order, status, tmp_dir, n):
    """A one-order vendor C micro-batch (as the stream reader delivers it)."""
    row = (order, "2024-01-15T10:30:00Z", json.dumps({"email": "q@r.jp", "country": "JP"}),
           json.dumps([{"sku": "S1", "qty": 1, "price": 1500}]),
           json.dumps({"method": "konbini", "currency": "JPY", "amount": 1500, "status": status}),
           f"{tmp_dir}/landing/orders_{n}.tsv")
    return spark.createDataFrame([row], "order_number string, created_at string, customer_info string, "
                                        "line_items string, payment_details string, _source_file string")


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))


def srt(items):
    """Sort like ``rows`` does."""
    return sorted(items, key=lambda t: tuple(str(x) for x in t))
