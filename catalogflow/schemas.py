"""Schemas and fixed values of the catalog data model."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_PRODUCTS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("designation", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("productid", T.LongType()),
        T.StructField("imageid", T.LongType()),
    ]
)

RAW_LABELS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("prdtypecode", T.IntegerType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("productid", T.LongType()),
        T.StructField("designation", T.StringType()),
        T.StructField("imageid", T.LongType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("date_pred", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("model_family", T.StringType()),
    ]
)

# The valid product type codes.
CLASS_CODES = [
    10, 40, 50, 60, 1140, 1160, 1180, 1280, 1281, 1300, 1301, 1302, 1320, 1560,
    1920, 1940, 2060, 2220, 2280, 2403, 2462, 2522, 2582, 2583, 2585, 2705, 2905,
]

# Names and order of the tabular and derived features.
TEXT_TABULAR = [
    "tab_text_length", "tab_word_count", "tab_designation_length", "tab_description_present",
    "tab_uppercase_ratio", "tab_digit_ratio", "tab_punct_density",
]
IMAGE_TABULAR = [
    "tab_image_width", "tab_image_height", "tab_image_aspect_ratio",
    "tab_image_brightness_mean", "tab_image_brightness_std",
]
DERIVED = [
    "agreement", "margin_text", "margin_image", "max_text", "max_image",
    "entropy_text", "entropy_image", "kl_text_img",
]
