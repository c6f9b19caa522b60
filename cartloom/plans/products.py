"""Product documents from classes, commercial master data and attribute texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions import text as tx
from cartloom.operators.relational import eav_wide, pivot_first


def product_title(description: Column, gender: Column, brand: Column) -> Column:
    """'Description Para Gender Brand' with the first letter of each in upper case."""
    return F.concat(
        tx.first_upper(description), F.lit(" Para "), tx.first_upper(tx.gender_word(gender)), F.lit(" "), tx.first_upper(brand)
    )


def product_docs(
    items: DataFrame, classes: DataFrame, plans: dict[str, str], master: DataFrame, known: DataFrame,
    departments: DataFrame, categories: DataFrame, brands: DataFrame, brand_words: list[str], release: Column,
) -> DataFrame:
    """Documents of unseen e-commerce items whose department, category and brand are mapped.

    ``plans`` names the class plans that hold flag, category, brand and gender.
    """
    unseen = items.withColumn("reference", F.trim("reference")).join(
        known.select(F.col("erp_reference").alias("reference")), "reference", "left_anti"
    )
    wide = pivot_first(classes, ["item_rowid"], "plan_id", "major_id", plans)
    rows = (
        unseen.join(wide, "item_rowid")
        .where(F.col("flag").contains("SI") & F.col("category").isNotNull() & F.col("brand").isNotNull() & F.col("gender").isNotNull())
        .join(master, "reference")
        .where(tx.like_any(F.col("brand_name"), brand_words))
        .join(departments.withColumnRenamed("shop_id", "department_id"), "gender")
        .join(categories.withColumnRenamed("shop_id", "category_id"), ["gender", "category"])
        .join(brands.withColumnRenamed("shop_id", "brand_id"), "brand")
        .where("department_id <> '' and category_id <> '' and brand_id <> ''")
    )
    d, g, b, ref = (F.col(c) for c in ("description", "gender_name", "brand_name", "reference"))
    about = F.concat(F.lower(d), F.lit(" para "), F.lower(tx.gender_word(g)), F.lit(" "), F.lower(b))
    body = F.struct(
        product_title(d, g, b).alias("Name"), F.col("department_id").cast("int").alias("DepartmentId"),
        F.col("category_id").cast("int").alias("CategoryId"), F.col("brand_id").cast("int").alias("BrandId"),
        F.concat(about, F.lit(" "), F.lower(ref)).alias("LinkId"), ref.alias("RefId"), F.lit(True).alias("IsVisible"),
        about.alias("Description"), tx.clip(F.lower(d), 50).alias("DescriptionShort"),
        F.date_format(release, "yyyy-MM-dd'T'HH:mm:ss").alias("ReleaseDate"),
        F.concat_ws(",", F.lower(d), F.lower(g), F.lower(b)).alias("KeyWords"), F.upper(d).alias("Title"),
        F.lit(True).alias("IsActive"), F.coalesce("tax_group", F.lit("")).alias("TaxCode"),
        F.lower(d).alias("MetaTagDescription"), F.lit(1).alias("SupplierId"), F.lit(False).alias("ShowWithoutStock"),
        F.lit(None).cast("string").alias("AdWordsRemarketingCode"), F.lit(None).cast("string").alias("LomadeeCampaignCode"),
        F.lit(1).alias("Score"),
    )
    return rows.select(ref.alias("reference"), F.to_json(body, {"ignoreNullFields": "false"}).alias("product")).distinct()


def product_docs_eav(
    items: DataFrame, classes: DataFrame, plans: dict[str, str], attributes: DataFrame, texts: dict[str, str],
    categories: DataFrame, known: DataFrame, width: int = 7,
) -> DataFrame:
    """Product rows from plan notes and attribute texts, one pass over each long table.

    Items need every plan and every text, a category of the same label, and a reference
    that was not sent before.
    """
    notes = pivot_first(classes, ["item_rowid"], "plan_id", "note", plans).dropna()
    labels = categories.select(tx.letters_digits(F.col("name")).alias("__label")).distinct()
    rows = (
        eav_wide(items.join(notes, "item_rowid"), attributes, ["item_rowid"], "attribute_id", "text_value", texts)
        .withColumn("__label", tx.letters_digits(F.col("category_label")))
        .join(labels, "__label", "left_semi")
        .withColumn("ref_id", tx.pad_left(F.col("item_id"), width))
    )
    fresh = rows.join(known.where("ref_id <> ''").select("ref_id").distinct(), "ref_id", "left_anti")
    name = F.trim("description")
    body = F.struct(
        tx.strip_newlines(name).alias("Name"), F.col("department").cast("int").alias("DepartmentId"),
        F.col("category").cast("int").alias("CategoryId"), F.col("brand").cast("int").alias("BrandId"),
        tx.slug(F.col("description")).alias("LinkId"), F.col("ref_id").alias("RefId"), F.lit(False).alias("IsVisible"),
        tx.strip_newlines(F.col("long_text")).alias("Description"),
        tx.strip_newlines(F.trim(F.col("short_text"))).alias("DescriptionShort"),
        tx.strip_newlines(F.replace(F.col("key_words"), F.lit("-"), F.lit(""))).alias("KeyWords"),
        tx.strip_newlines(name).alias("Title"), F.lit(False).alias("IsActive"), F.lit(1).alias("Score"),
    )
    return fresh.select("ref_id", F.to_json(body).alias("product")).distinct()
