"""The six source tables: column names and logical types."""

from __future__ import annotations

# Columns of each source table and their types.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "purchases": {
        "InventoryId": "string", "Store": "bigint", "Brand": "bigint", "Description": "string",
        "Size": "string", "VendorNumber": "bigint", "VendorName": "string",
        "PONumber": "bigint", "PODate": "date", "ReceivingDate": "date",
        "InvoiceDate": "date", "PayDate": "date", "PurchasePrice": "double",
        "Quantity": "bigint", "Dollars": "double", "Classification": "bigint",
    },
    "sales": {
        "InventoryId": "string", "Store": "bigint", "Brand": "bigint", "Description": "string",
        "Size": "string", "SalesQuantity": "bigint", "SalesDollars": "double",
        "SalesPrice": "double", "SalesDate": "date", "Volume": "double",
        "Classification": "bigint", "ExciseTax": "double", "VendorNo": "bigint",
        "VendorName": "string",
    },
    "purchase_prices": {
        "Brand": "bigint", "Description": "string", "Price": "double", "Size": "string",
        "Volume": "string", "Classification": "bigint", "PurchasePrice": "double",
        "VendorNumber": "bigint", "VendorName": "string",
    },
    "vendor_invoice": {
        "VendorNumber": "bigint", "VendorName": "string", "InvoiceDate": "date",
        "PONumber": "bigint", "PODate": "date", "PayDate": "date", "Quantity": "bigint",
        "Dollars": "double", "Freight": "double", "Approval": "string",
    },
    "begin_inventory": {
        "InventoryId": "string", "Store": "bigint", "City": "string", "Brand": "bigint",
        "Description": "string", "Size": "string", "onHand": "bigint", "Price": "double",
        "startDate": "date",
    },
    "end_inventory": {
        "InventoryId": "string", "Store": "bigint", "City": "string", "Brand": "bigint",
        "Description": "string", "Size": "string", "onHand": "bigint", "Price": "double",
        "endDate": "date",
    },
}
SOURCE_TABLES = tuple(SOURCE_COLUMNS)


# The warehouse form of the purchases table, in its column order.
RAW_PURCHASES_COLUMNS = (
    ("INVENTORY_ID", "string", "InventoryId"), ("STORE", "decimal(38,0)", "Store"),
    ("BRAND", "decimal(38,0)", "Brand"), ("DESCRIPTION", "string", "Description"),
    ("SIZE", "string", "Size"), ("VENDOR_NUMBER", "decimal(38,0)", "VendorNumber"),
    ("VENDOR_NAME", "string", "VendorName"), ("PO_NUMBER", "decimal(38,0)", "PONumber"),
    ("PO_DATE", "date", "PODate"), ("RECEIVING_DATE", "date", "ReceivingDate"),
    ("INVOICE_DATE", "date", "InvoiceDate"), ("PAY_DATE", "date", "PayDate"),
    ("PURCHASE_PRICE", "double", "PurchasePrice"), ("QUANTITY", "decimal(38,0)", "Quantity"),
    ("DOLLARS", "double", "Dollars"), ("CLASSIFICATION", "decimal(38,0)", "Classification"),
)


def raw_purchases(purchases):
    """The purchases table under its warehouse names and types."""
    return purchases.select(
        *[purchases[source].cast(t).alias(n) for n, t, source in RAW_PURCHASES_COLUMNS]
    )
