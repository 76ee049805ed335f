"""Verified token claims to tenant scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIMS_SCHEMA = "iss string, aud string, preferred_username string, groups array<string>"


def claims_to_scope(claims: DataFrame, issuer: str, audience: str, now: Column) -> DataFrame:
    """One row per claims document (`claims` JSON): username, tenants, and why it was rejected, if it was.

    Tenants come from the claims alone. `now` is in epoch seconds; `aud` may be one name or a list. A time claim that is
    there but is not a number rejects, as does one not yet reached (`nbf`, `iat`); blank groups are no tenants.
    """
    # A typed field of the top level is read from a number only; text, a list or an object there gives null.
    present = lambda name: F.get_json_object("claims", f"$.{name}").isNotNull()
    number = lambda name: F.from_json("claims", f"{name} double")[name]
    groups = F.filter("_c.groups", lambda g: F.trim(g) != "")
    parsed = F.from_json("claims", CLAIMS_SCHEMA)
    audiences = F.from_json(F.get_json_object("claims", "$.aud"), "array<string>")
    rows = claims.withColumns({"_c": parsed, "_aud": audiences})
    fits = F.coalesce(
        F.array_contains("_aud", audience) | (F.col("_c.aud") == audience), F.col("_c.aud") == audience, F.lit(False)
    )
    reason = (
        F.when(F.coalesce(F.col("_c.iss") != issuer, F.lit(True)), "wrong issuer")
        .when(~fits, "wrong audience")
        .when(present("exp") & number("exp").isNull(), "unreadable time")
        .when((present("nbf") & number("nbf").isNull()) | (present("iat") & number("iat").isNull()), "unreadable time")
        .when(F.coalesce(number("exp") <= now, F.lit(False)), "expired")
        .when(F.coalesce((number("nbf") > now) | (number("iat") > now), F.lit(False)), "not valid yet")
        .when(F.coalesce(F.size(groups), F.lit(0)) <= 0, "belongs to no tenant")
    )
    return rows.select(
        *claims.columns,
        F.coalesce("_c.preferred_username", F.lit("?")).alias("username"),
        F.when(reason.isNull(), groups).alias("tenants"),
        reason.alias("rejected"),
    )


def accepted(scopes: DataFrame) -> DataFrame:
    return scopes.where(F.col("rejected").isNull()).drop("rejected", "claims")


def rejected(scopes: DataFrame) -> DataFrame:
    return scopes.where(F.col("rejected").isNotNull()).drop("tenants")
