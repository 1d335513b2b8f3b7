"""Input schemas of the table families as DDL. Streams must declare theirs; batch reads infer."""

from __future__ import annotations

SALES = (
    "txn_id STRING, store_id INT, register_id INT, product_id INT, product_code STRING, "
    "customer_id INT, quantity INT, unit_price DECIMAL(10,2), discount_pct DECIMAL(5,2), "
    "currency STRING, status STRING, channel STRING, payment_method STRING, "
    "country_code STRING, event_ts TIMESTAMP"
)

SALES_OLD = (
    "transaction_id STRING, store_id INT, product_id INT, customer_id INT, quantity INT, "
    "unit_price DECIMAL(10,2), discount_pct DECIMAL(5,2), currency STRING, status STRING, "
    "transaction_timestamp TIMESTAMP"
)

PRODUCTS = "product_id INT, product_name STRING"

PAYMENTS = (
    "txn_id STRING, txn_ts TIMESTAMP_NTZ, card_token STRING, amount DECIMAL(14,2), "
    "currency_code STRING, country_code STRING, mcc STRING, merchant_id STRING, "
    "acquirer_bin STRING, response_code STRING, entry_mode STRING, channel STRING"
)

PAYMENTS_WIDE = (
    "txn_id STRING, txn_ts TIMESTAMP_NTZ, card_number STRING, amount DECIMAL(14,2), "
    "currency_code STRING, country_code STRING, mcc STRING, merchant_id STRING, "
    "acquirer_bin STRING, response_code STRING, entry_mode STRING, channel STRING, "
    "merchant_country STRING, auth_code STRING, settled BOOLEAN"
)

RATES = (
    "rate_id STRING, mcc STRING, country_code STRING, entry_mode STRING, "
    "effective_from DATE, effective_to DATE, rate_bps INT, fixed_fee DECIMAL(6,4), "
    "program_code STRING, program_name STRING"
)

CLICK_EVENTS = (
    "event_id BIGINT, product_id INT, event_type STRING, amount DECIMAL(10,2), quantity INT, "
    "session_id STRING, visitor_id STRING, channel STRING, country_code STRING"
)

CATALOG = (
    "product_id INT, product_name STRING, category STRING, brand STRING, "
    "list_price DECIMAL(10,2), effective_ts DATE, payload BINARY"
)

# Event-time columns are TIMESTAMP: a watermark is refused on TIMESTAMP_NTZ.
IMPRESSIONS = (
    "impression_id STRING, visitor_id STRING, campaign_id STRING, impression_ts TIMESTAMP, "
    "channel STRING"
)

PURCHASES = (
    "purchase_id STRING, visitor_id STRING, product_id INT, amount DECIMAL(10,2), "
    "purchase_ts TIMESTAMP"
)

WIDE_EVENTS = (
    "event_id BIGINT, event_ts TIMESTAMP_NTZ, amount DECIMAL(12,2), region STRING, payload STRING"
)
