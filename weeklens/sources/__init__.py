from weeklens.sources.tables import (
    read_table, transactions, customers, products, load_raw,
    TRANSACTION_COLUMNS, CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES,
)

__all__ = [
    "read_table", "transactions", "customers", "products", "load_raw",
    "TRANSACTION_COLUMNS", "CUSTOMER_ATTRIBUTES", "PRODUCT_ATTRIBUTES",
]
