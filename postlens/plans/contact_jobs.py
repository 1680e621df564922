"""The contact jobs: cleaned contacts, profiles and scores; then the serving tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.operators.clean import clean_contact_posts, dedupe_posts
from postlens.operators.contact_state import ContactState, contact_state, merge_contacts
from postlens.operators.contacts import (
    contact_fact,
    latest_profile,
    mirror_contacts,
    profiles_seen,
    score_contacts,
    score_texts,
)
from postlens.operators.nesting import KEYS, contacts_to_json, nest_contacts
from postlens.operators.skew import heavy_keys
from postlens.operators.texts import number_texts, with_texts
from postlens.sources.readers import read_posts, read_table
from postlens.sources.sinks import cluster, table_path, write_jdbc, write_table
from postlens.sources.staging import stage


# The tables of a state, in the order of its fields.
_STATE = ("state_contacts", "state_weights", "state_texts", "state_profiles")


def numbered_contact_tables(raw: DataFrame, staging_folder: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(profiles, contact_scored, texts)`` from raw posts, the scored contacts with numbers for texts."""
    numbered, texts = number_texts(clean_contact_posts(raw), staging_folder)
    contacts = stage(dedupe_posts(numbered), "contacts", staging_folder)
    return latest_profile(profiles_seen(contacts)), score_contacts(contacts), texts


def contact_tables(raw: DataFrame, staging_folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(profiles, contact_scored)`` from raw posts; only staged tables are written."""
    profiles, scored, texts = numbered_contact_tables(raw, staging_folder)
    return profiles, with_texts(scored, texts)


def run_contact_etl(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    suffix: str | None = None,
    staging_folder: str | None = None,
) -> None:
    """Posts to the tables ``profiles`` and ``contact_scored``.

    The cleaned contacts feed three aggregations, each with its own columns, so they are
    staged as a table instead of being cleaned, or cached whole, three times. Their texts are
    staged once each, and meet the scored contacts at the end.
    """
    profiles, scored = contact_tables(read_posts(spark, input_path), staging_folder)
    write_table(profiles, table_path(output_path, "profiles", suffix))
    write_table(scored, table_path(output_path, "contact_scored", suffix))


def run_contact_update(
    spark: SparkSession, input_path: str, output_path: str, suffix: str, before: str | None = None,
    staging_folder: str | None = None,
) -> None:
    """New posts taken into the tables of an earlier run, ``before``; the result gets a suffix of its own.

    Tables are never changed in place: a run that fails leaves the earlier ones as they are, and is
    run again. Without ``before`` the posts are the first ones.
    """
    fresh = stage(clean_contact_posts(read_posts(spark, input_path)), "contacts", staging_folder)
    state = merge_contacts(read_contact_state(spark, output_path, before), fresh) if before else contact_state(fresh)
    for name, table in zip(_STATE, state):
        write_table(table, table_path(output_path, name, suffix))


def read_contact_state(spark: SparkSession, output_path: str, suffix: str) -> ContactState:
    return ContactState(*(read_table(spark, table_path(output_path, name, suffix)) for name in _STATE))


def scored_of_state(state: ContactState) -> DataFrame:
    """``contact_scored`` as the job over all posts makes it."""
    return score_texts(state.texts, state.weights)


def _heavy(contacts: DataFrame, key: str) -> DataFrame:
    return heavy_keys(contacts.groupBy(key).agg(F.count("*").alias("n")), [key], "n")


def run_contact_serving(
    spark: SparkSession, profiles_path: str, scored_path: str, output_path: str, suffix: str | None = None,
    staging_folder: str | None = None,
) -> None:
    """The flat table ``contact_fact``, clustered by user for point lookups.

    The joined rows are staged first: finding the ranges reads their keys, not the join again.
    """
    scored = read_table(spark, scored_path)
    heavy = _heavy(mirror_contacts(scored), "user2_id")
    facts = stage(contact_fact(scored, read_table(spark, profiles_path), heavy), "contact-fact", staging_folder)
    clustered = cluster(facts, ["user1_id", "user2_id", "created_at"], ["text"])
    write_table(clustered, table_path(output_path, "contact_fact", suffix))


def export_contacts(
    facts: DataFrame, url: str, table: str, properties: Mapping[str, str], text_type: str, **options
) -> None:
    """Nested contacts as JSON columns into a relational table.

    ``text_type`` is the store's type for long text, such as ``clob`` or ``mediumtext``.
    """
    encoded = contacts_to_json(nest_contacts(facts))
    types = ", ".join(["user1_id bigint", "month varchar(7)", "chunk int"] + [
        f"{c} {text_type}" for c in encoded.columns if c not in KEYS
    ])
    write_jdbc(encoded, url, table, properties, types, **options)
