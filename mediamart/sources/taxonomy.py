"""Topic taxonomy: constant relations of categories and subcategories."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.schemas import CONTRACTS

# Category names in id order (1-10), each with its subcategory names; the
# subcategory ids run from 1 to 50 through the whole list.
TAXONOMY = {
    "Advertising": [
        "Upcoming shows & live events",
        "Streaming platforms & online services",
        "Marketplaces & e-commerce",
        "Tech products & gadgets",
        "Food & beverages",
        "Travel & lifestyle services",
        "Finance & banking apps",
        "Health & fitness products",
        "Mobile operators & internet providers",
        "Education & online courses",
    ],
    "Politics & Society": [
        "Political satire",
        "Social commentary & inequality",
        "Human rights & activism",
        "Immigration & migration",
        "Law, crime & justice",
        "Censorship & freedom of speech",
    ],
    "Economy, Work & Money": [
        "Workplace humor & office culture",
        "Money & personal finance",
        "Career struggles & unemployment",
        "Business & entrepreneurship",
    ],
    "Health, Body & Mind": [
        "Physical health & fitness",
        "Mental health & therapy",
        "Addictions & substance use",
        "Aging & body image",
    ],
    "Relationships & Social Life": [
        "Dating & romance",
        "Marriage & family life",
        "Friendship & social circles",
        "Sex & intimacy",
        "Parenting",
    ],
    "Science, Technology & Digital Life": [
        "Tech & gadgets",
        "Internet culture, memes & influencers",
        "Artificial intelligence & future tech",
        "Science news & discoveries",
    ],
    "Culture, Arts & Media": [
        "Movies, TV & streaming",
        "Music & live performance",
        "Literature & art references",
        "Celebrities & fame",
        "Pop culture trends",
    ],
    "Environment & Planet": [
        "Climate change & sustainability jokes",
        "Animals & pets",
        "Urban vs rural life",
        "Natural disasters & weather humor",
    ],
    "History, Identity & Heritage": [
        "Historical events satire",
        "Cultural traditions & heritage",
        "Generational differences & nostalgia",
        "National stereotypes",
    ],
    "Dark, Edgy & Absurd Humor": [
        "Morbid comedy & death jokes",
        "Offensive or taboo topics",
        "Self-deprecating humor",
        "Surreal or absurd comedy",
    ],
}

CATEGORY_ROWS = [(i, name) for i, name in enumerate(TAXONOMY, 1)]
SUBCATEGORY_ROWS = [
    (i, category_id, name)
    for i, (category_id, name) in enumerate(
        ((c, name) for c, names in enumerate(TAXONOMY.values(), 1) for name in names), 1
    )
]


def _constant(spark: SparkSession, rows: list[tuple], name: str) -> DataFrame:
    """Rows of the contract ``name`` as literals: Spark knows their size, so it broadcasts them by itself, and no
    Python worker makes them."""
    fields = CONTRACTS[name].fields
    made = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*made)))


def categories(spark: SparkSession) -> DataFrame:
    """``core_categories``: 10 rows."""
    return _constant(spark, CATEGORY_ROWS, "core_categories")


def subcategories(spark: SparkSession) -> DataFrame:
    """``core_subcategories``: 50 rows."""
    return _constant(spark, SUBCATEGORY_ROWS, "core_subcategories")


def nested_labels(df: DataFrame, outer: str, order: str, inner: str, member: str) -> DataFrame:
    """One JSON object per ``outer`` value: ``{outer, member: [inner values in order]}``.

    Pairs are made distinct before they are gathered, so each array is bounded by the number
    of different labels and not by the number of rows.
    """
    gathered = (
        df.select(outer, order, inner)
        .distinct()
        .groupBy(outer)
        .agg(F.sort_array(F.collect_list(F.struct(order, inner))).alias("labels"))
    )
    names: Column = F.transform("labels", lambda label: label[inner])
    return gathered.select(outer, F.to_json(F.struct(outer, names.alias(member))).alias("json"))


def taxonomy_json(spark: SparkSession) -> DataFrame:
    """The taxonomy as nested JSON, one object per main category."""
    labels = subcategories(spark).join(F.broadcast(categories(spark)), "category_id")
    return nested_labels(labels, "main_category", "subcategory_id", "subcategory", "subcategories")
