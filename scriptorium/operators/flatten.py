"""Pages with figures to training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import clean, has_ink

IMAGES = "array<struct<path:string,position:struct<x:int,y:int,width:int,height:int>,analysis:string,caption:string>>"
ROW = "struct<type:string,content:string,page:int,image_path:string>"


def clean_pages(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", clean(F.col("text")))


def describe_figures(pages: DataFrame, told: DataFrame) -> DataFrame:
    """pages with analysis and caption set on images that have a path, from told (doc_id, path, analysis, caption: a row a figure). A figure is
    analysed and captioned once, however many pages show it."""
    figures = pages.select("doc_id", "page_number", F.posexplode_outer("images").alias("k", "i"))
    joined = figures.join(told.select("doc_id", F.col("path").alias("__path"), F.col("analysis").alias("__a"), F.col("caption").alias("__c")), (figures["doc_id"] == told["doc_id"]) & (F.col("i.path") == F.col("__path")), "left")
    image = F.struct(F.col("i.path").alias("path"), F.col("i.position").alias("position"), F.coalesce("__a", "i.analysis").alias("analysis"), F.coalesce("__c", "i.caption").alias("caption"))
    whole = joined.groupBy(figures["doc_id"], "page_number").agg(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", image.alias("i"))))).alias("__images"))
    return pages.drop("images").join(whole, ["doc_id", "page_number"], "left").withColumn("images", F.transform("__images", lambda x: x["i"])).drop("__images")


def training_rows(pages: DataFrame) -> DataFrame:
    """doc_id, seq (order within the document's page), type, content, page, image_path: a text row if the page's text isn't blank, then one for each
    captioned image. Position and analysis are left out."""
    page = F.col("page_number").cast("int")
    text = F.struct(F.lit("text").alias("type"), F.col("text").alias("content"), page.alias("page"), F.lit(None).cast("string").alias("image_path"))
    shown = F.filter(F.coalesce("images", F.array().cast(IMAGES)), lambda i: F.coalesce(i["caption"], F.lit("")) != "")
    images = F.transform(shown, lambda i: F.struct(F.lit("image").alias("type"), i["caption"].alias("content"), page.alias("page"), F.coalesce(i["path"], F.lit("")).alias("image_path")))
    rows = F.concat(F.when(has_ink(F.col("text")), F.array(text)).otherwise(F.array().cast(f"array<{ROW}>")), images)
    return pages.select("doc_id", F.posexplode(rows).alias("seq", "r")).select("doc_id", "seq", "r.*")
