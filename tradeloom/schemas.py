"""Column contract of the nine raw files.

Schemas are DDL text, which ``DataFrameReader.schema`` accepts directly. A CSV
reader reports every column as nullable whatever the schema says, so NOT NULL
documents the source contract; the silver functions filter on it explicitly.
"""

# Column names and types of the source files, misspelt headers
# ("lenght") included. They have to equal the files' own headers.
RAW_SCHEMAS = {
    "orders": """
        order_id STRING NOT NULL,
        customer_id STRING NOT NULL,
        order_status STRING,
        order_purchase_timestamp TIMESTAMP,
        order_approved_at TIMESTAMP,
        order_delivered_carrier_date TIMESTAMP,
        order_delivered_customer_date TIMESTAMP,
        order_estimated_delivery_date TIMESTAMP""",
    "order_items": """
        order_id STRING NOT NULL,
        order_item_id INT NOT NULL,
        product_id STRING NOT NULL,
        seller_id STRING NOT NULL,
        shipping_limit_date TIMESTAMP,
        price DOUBLE,
        freight_value DOUBLE""",
    "order_payments": """
        order_id STRING NOT NULL,
        payment_sequential INT,
        payment_type STRING,
        payment_installments INT,
        payment_value DOUBLE""",
    "order_reviews": """
        review_id STRING NOT NULL,
        order_id STRING NOT NULL,
        review_score INT,
        review_comment_title STRING,
        review_comment_message STRING,
        review_creation_date TIMESTAMP,
        review_answer_timestamp TIMESTAMP""",
    "customers": """
        customer_id STRING NOT NULL,
        customer_unique_id STRING NOT NULL,
        customer_zip_code_prefix STRING,
        customer_city STRING,
        customer_state STRING""",
    "products": """
        product_id STRING NOT NULL,
        product_category_name STRING,
        product_name_lenght INT,
        product_description_lenght INT,
        product_photos_qty INT,
        product_weight_g INT,
        product_length_cm INT,
        product_height_cm INT,
        product_width_cm INT""",
    "sellers": """
        seller_id STRING NOT NULL,
        seller_zip_code_prefix STRING,
        seller_city STRING,
        seller_state STRING""",
    "geolocation": """
        geolocation_zip_code_prefix STRING,
        geolocation_lat DOUBLE,
        geolocation_lng DOUBLE,
        geolocation_city STRING,
        geolocation_state STRING""",
    "category_translation": """
        product_category_name STRING NOT NULL,
        product_category_name_english STRING""",
}

# Fixed value: how timestamps are written in the source files.
RAW_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
