"""Constant lookups of the feeds as small relations.

The long camera-to-district list, the district repairs and the addresses of weather pages
change with the city; they are read from CSV files the caller names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cameras read in every round, by district.
ROUND_CAMERAS = {
    "Bình Chánh": ["5ad06a0d98d8fc001102e27b", "662a87df1afb9c00172d2522", "6792f03d8c5ed4001b27f378"],
    "Quận 1": ["65e054fb6b18080018db6632", "662b85bf1afb9c00172dd149", "662b811d1afb9c00172dcc1d",
               "662b7d0c1afb9c00172dc6a6", "662b82da1afb9c00172dce94"],
    "Quận 10": ["63ae7a74bfd3d90017e8f2c7", "6623e7076f998a001b2523ea"],
    "Quận 12": ["595dd7693dcfc400106f28b0"],
    "Quận 3": ["5deb576d1dc17d7c5515ad0e", "5deb576d1dc17d7c5515ad11", "662b80e81afb9c00172dcbec",
               "63ae73cebfd3d90017e8f00d", "5deb576d1dc17d7c5515acf8"],
    "Quận 4": ["63ae76ddbfd3d90017e8f11b"],
    "Quận 5": ["66f1266f538c780017c93579", "66b1c190779f740018673ed4", "63b3c274bfd3d90017e9ab93",
               "662b4efc1afb9c00172d86bc"],
    "Quận 7": ["662a8ef41afb9c00172d2af2", "662a8c931afb9c00172d2901"],
    "Quận 9": ["63b54996bfd3d90017ea781a", "63b54938bfd3d90017ea77f6", "59d3414302eb490011a0a610"],
    "Bình Thạnh": ["6623e7b76f998a001b25242d", "63b66051bfd3d90017eaa4a3", "5a8255a55058170011f6eac7",
                   "5d9dddb9766c880017188c96"],
    "Bình Tân": ["662a881a1afb9c00172d2559", "662b51201afb9c00172d889a"],
    "Gò Vấp": ["5a6066608576340017d06617", "6623ed9b6f998a001b2526cd"],
    "Thủ Đức": ["5d8cd7bb766c880017188952", "5d8cd653766c88001718894c"],
    "Tân Bình": ["5deb576d1dc17d7c5515ad08", "66b1c4e7779f7400186741e4", "5deb576d1dc17d7c5515ad09"],
    "Tân Phú": ["6623f1046f998a001b2527db"],
    "Phú Nhuận": ["6623e8da6f998a001b2524a6"],
    "Hóc Môn": ["6623ef2b6f998a001b252753", "6623efc26f998a001b25277f"],
    "Quận 2": ["649da495a6068200171a6cb6", "63b5503bbfd3d90017ea7ccc"],
    "Quận 6": ["5d8cd326766c88001718893e", "662b4f7e1afb9c00172d872e", "66b1c22f779f740018673f6e"],
    "Quận 11": ["5a824c905058170011f6eab0"],
    "Nhà Bè": ["5d9de3c2766c880017188cb3"],
}

# The busiest camera of a district.
TOP_CAMERAS = {
    "Quận 10": "63ae7a74bfd3d90017e8f2c7",
    "Quận 11": "5a824c905058170011f6eab0",
    "Quận 12": "595dd7693dcfc400106f28b0",
    "Quận 3": "63ae73cebfd3d90017e8f00d",
    "Quận 4": "63ae76ddbfd3d90017e8f11b",
    "Quận 6": "66b1c22f779f740018673f6e",
    "Bình Tân": "662a881a1afb9c00172d2559",
    "Thủ Đức": "5d8cd653766c88001718894c",
    "Tân Bình": "5deb576d1dc17d7c5515ad08",
    "Tân Phú": "6623f1046f998a001b2527db",
}


def round_cameras(spark: SparkSession) -> DataFrame:
    """``district, cam_id`` of every camera read in a round."""
    rows = [(ROUND_CAMERAS,)]
    lists = spark.createDataFrame(rows, "cameras map<string, array<string>>")
    by_district = lists.select(F.explode("cameras").alias("district", "cam_ids"))
    return by_district.select("district", F.explode("cam_ids").alias("cam_id"))


def top_cameras(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TOP_CAMERAS.items()), "district string, cam_id string")


def weather_pages(spark: SparkSession, path: str) -> DataFrame:
    """``district, url`` of every weather page, from a CSV file with a header."""
    return spark.read.schema("district string, url string").option("header", True).csv(path)


def camera_districts(spark: SparkSession, path: str) -> DataFrame:
    """``id, district`` pairs of a CSV file with a header."""
    return spark.read.schema("id string, district string").option("header", True).csv(path)


def district_repairs(spark: SparkSession, path: str) -> DataFrame:
    """``id, district, priority`` of a CSV file with a header; the lowest priority counts."""
    schema = "id string, district string, priority int"
    return spark.read.schema(schema).option("header", True).csv(path)
