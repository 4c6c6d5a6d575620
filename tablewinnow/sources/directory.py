"""Nested user, group and metadata objects as flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewinnow.sources.documents import RANGE_BYTES, is_object, lists_of_objects

CREDENTIALS = "userCredentials"


def username_of(users: DataFrame) -> Column:
    """The username, nested under the credentials or else flat."""
    places = []
    if "userCredentials" in users.columns:
        places.append(F.col("userCredentials")["username"])
    if "username" in users.columns:
        places.append(F.col("username"))
    return F.coalesce(*places)


def flat_users(users: DataFrame) -> DataFrame:
    """(id, username, disabled) of nested user objects; disabled is null where no object
    says."""
    named = "disabled" in users.schema[CREDENTIALS].dataType.names
    disabled = F.col(CREDENTIALS)["disabled"] if named else F.lit(None).cast("boolean")
    return users.select("id", username_of(users).alias("username"), disabled.alias("disabled"))


def role_links(users: DataFrame) -> DataFrame:
    """(user_id, role_id) of nested user objects."""
    roles = users.select(
        F.col("id").alias("user_id"), F.explode("userCredentials.userRoles").alias("role")
    )
    return roles.select("user_id", F.col("role")["id"].alias("role_id"))


def group_members(groups: DataFrame) -> DataFrame:
    """(group_name, user_id) of nested group objects."""
    members = groups.select(F.col("name").alias("group_name"), F.explode("users").alias("user"))
    return members.select("group_name", F.col("user")["id"].alias("user_id"))


# A larger document is cut into ranges.
WHOLE_BYTES = 64 << 20


def read_metadata(
    spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES, range_bytes: int = RANGE_BYTES
) -> dict[str, DataFrame]:
    """One table per list of objects in a JSON metadata document.

    A file of at most ``whole_bytes``, a compressed one, and one that is no object are read as one
    value by one task; several files below ``path`` are read in parallel. A larger file is cut
    into ranges of ``range_bytes``, see ``lists_of_objects``.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    large = len(files) == 1 and files[0].length > whole_bytes
    if large and not path.endswith((".gz", ".bz2")) and is_object(files[0].path):
        return lists_of_objects(spark, files[0].path, files[0].length, range_bytes)
    document = spark.read.option("multiLine", True).json(path)
    return {
        field.name: document.select(F.inline(F.col(f"`{field.name}`")))
        for field in document.schema.fields
        if isinstance(field.dataType, T.ArrayType)
        and isinstance(field.dataType.elementType, T.StructType)
    }
