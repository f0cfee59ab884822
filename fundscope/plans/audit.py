"""Flattened views: proposals, tasks, activities with audit names, prospects
(P2, P9, P10, P10b, P11, P12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import kept_owner
from ..operators.relational import bridge_left_join, role_join, star_flatten
from ..params import Params
from ..sources.crm_store import hot_keys
from ..sources.standins import Crm


def proposals(crm: Crm) -> DataFrame:
    """Opportunity x team member with the account name."""
    opp = crm.opportunity
    team = crm.opportunity_team.select(F.col("opportunity_id"), F.col("name").alias("solicitor"),
                                       F.col("role").alias("solicitor_level"))
    acc = crm.account.select(F.col("id").alias("__acc"), F.col("name").alias("AccountName"))
    j = (bridge_left_join(opp, team, "id", "opportunity_id", known_hot=hot_keys(crm, "opportunity_team"))
         .join(acc, F.col("account_id") == acc.__acc, "left"))
    return j.select(F.col("owner_id").alias("do_id"),
                    F.col("lead_solicitor_id").alias("Lead_Solicitor_ID"),
                    F.col("ask_date"), F.col("ask_amount").alias("ask_amt"),
                    F.col("amount").alias("gift_amt"), F.col("close_date").alias("gift_date"),
                    "solicitor", "solicitor_level",
                    F.col("name").alias("gift_name"), F.col("division").alias("gift_unit"),
                    F.col("id").alias("OpportunityID"), F.col("stage").alias("StageName"),
                    F.col("comment").alias("Comment"), F.col("account_id").alias("AccountID"),
                    "AccountName")


def proposal_wide(crm: Crm) -> DataFrame:
    """Every opportunity column with each team member's name and role."""
    opp = crm.opportunity
    team = crm.opportunity_team.select(F.col("opportunity_id"), F.col("name").alias("DO_name"),
                                       F.col("role").alias("TeamMemberRole"))
    j = bridge_left_join(opp, team, "id", "opportunity_id", known_hot=hot_keys(crm, "opportunity_team"))
    return j.select(F.col("id").alias("OpportunityID"), F.col("stage").alias("StageName"),
                    F.col("owner_id").alias("OwnerID"),
                    F.col("lead_solicitor_id").alias("Lead_Solicitor_ID"),
                    F.col("account_id").alias("AccountID"),
                    F.col("name").alias("Opportunity_name"), F.col("ask_date").alias("Ask_Date"),
                    F.col("ask_amount").alias("Ask_Amount"), F.col("close_date").alias("Close_Date"),
                    F.col("amount").alias("Amount"), F.col("division").alias("Division"),
                    F.col("campaign_fund").alias("CampaignFund"),
                    F.col("comment").alias("Comment"), F.col("fiscal_year").alias("Fiscal_Yr"),
                    F.col("fiscal_quarter").alias("Fiscal_Qtr"), "DO_name", "TeamMemberRole")


def prospects(crm: Crm) -> DataFrame:
    """Each contact with its account's columns and totals."""
    acc = crm.account.select(
        F.col("id").alias("Account_Id"), F.col("name").alias("Account_Name"),
        F.col("external_id").alias("Gambit_Id"), F.col("status").alias("Account_Status"),
        F.col("account_type").alias("Account_Type"), F.col("district").alias("District"),
        F.col("region").alias("Region"), F.col("billing_city").alias("Billing_City"),
        F.col("billing_country").alias("Billing_Country"), F.col("billing_state").alias("Billing_State"),
        F.col("billing_postal_code").alias("Billing_Postal_Code"), F.col("capacity").alias("GU_Capacity"))
    totals = crm.account_totals.select(
        F.col("account_id").alias("__of"), F.col("total_gifts").alias("Total_Gifts"),
        F.col("total_gifts_count").alias("Total_Gifts_Count"),
        F.col("number_of_contacts").alias("Number_of_Contacts"),
        F.col("relationship_manager").alias("Relationship_Manager"))
    con = crm.contact.select(
        F.col("account_id").alias("__acc"), F.col("id").alias("Contact_Id"), F.col("name").alias("Contact_Name"),
        F.col("age").alias("Age"), F.col("degree").alias("Degree"), F.col("degree_year").alias("Degree_Year"),
        F.col("school").alias("School"), F.col("contact_type").alias("Category"),
        F.col("birthdate").alias("Birthdate"), F.col("email").alias("Contact_Email"),
        F.col("label").alias("GUSY"), F.col("pasy").alias("PASY"), F.col("gender").alias("Gender"),
        F.col("affiliations").alias("Affilication"),
        F.col("primary_affiliation").alias("Primary_Affiliation"), F.col("religion").alias("Religion"))
    # the account's columns meet its totals once, before the contacts
    wide = acc.join(totals, F.col("Account_Id") == F.col("__of"), "left").drop("__of")
    return con.join(wide, F.col("__acc") == F.col("Account_Id"), "left").drop("__acc")


def _audit_names(df: DataFrame, crm: Crm) -> DataFrame:
    """Creator, modifier and owner names (one user table, three roles) and
    the record type name."""
    return star_flatten(df, [
        (crm.user, "created_by", "id", {"name": "CreatedByName"}),
        (crm.user, "modified_by", "id", {"name": "LastModifiedByName"}),
        (crm.user, "owner_id", "id", {"name": "OwnerName"}),
        (crm.record_type, "record_type_id", "id", {"name": "RecordTypeName"}),
    ])


def audit_names(crm: Crm) -> DataFrame:
    """Every activity with its creator, modifier and owner names and its
    record type (the role-played user joins, no filter)."""
    a = _audit_names(crm.activity, crm)
    return a.select(F.col("id").alias("activity_id"), "CreatedByName", "LastModifiedByName",
                    "OwnerName", "RecordTypeName")


def tasks(crm: Crm) -> DataFrame:
    """Tasks with creator / modifier / owner names and record type."""
    t = _audit_names(crm.task, crm)
    return t.select(F.col("id").alias("Id"), F.col("account_id").alias("AccountId"),
                    F.col("activity_date").alias("ActivityDate"),
                    F.col("created_by").alias("CreatedById"), "CreatedByName",
                    F.col("created_date").alias("CreatedDate"),
                    F.col("modified_by").alias("LastModifiedById"), "LastModifiedByName",
                    F.col("modified_date").alias("LastModifiedDate"),
                    F.col("owner_id").alias("OwnerId"), "OwnerName",
                    F.col("gambit_key").alias("Gambit_Key"), F.col("external_id").alias("External_Id"),
                    F.col("record_type_id").alias("RecordTypeId"),
                    F.col("RecordTypeName").alias("recordType"),
                    F.col("type").alias("Type"), F.col("subtype").alias("TaskSubtype"),
                    F.col("system_modstamp").alias("SystemModstamp"),
                    F.col("what_id").alias("WhatId"), F.col("who_id").alias("WhoId"))


def activity_audit(crm: Crm, params: Params) -> DataFrame:
    """P10: visit-type activities with audit names; excluded or unnamed
    owners dropped."""
    a = crm.activity.where(F.col("type").isin(list(params.visit_types)))
    a = _audit_names(a, crm).where(kept_owner("OwnerName", params.excluded_owners, params.collation))
    return a.select(F.col("owner_id").alias("OwnerID"), "OwnerName",
                    F.col("type").alias("ActivityType"), F.col("status").alias("ActivityStatus"),
                    F.col("description").alias("Activity_Description"),
                    F.col("substantive").alias("Substantive_Activity"),
                    F.col("activity_date").alias("ActivityDate"),
                    F.col("system_modstamp").alias("SystemModstamp"),
                    F.col("record_type_id").alias("RecordTypeID"), "RecordTypeName",
                    F.col("account_id").alias("Account_ID"),
                    F.col("who_id").alias("Contact_WhoID"),
                    F.col("created_by").alias("CreatedByID"), "CreatedByName",
                    F.col("created_date").alias("CreatedDate"),
                    F.col("modified_by").alias("LastModifiedByID"), "LastModifiedByName",
                    F.col("modified_date").alias("LastModifiedDate"),
                    F.col("gambit_key").alias("Gambit_Key"), F.col("external_id").alias("External_ID"),
                    F.col("contactor_1").alias("Contactor"), F.col("contactor_2").alias("Contactor2"),
                    F.col("contactor_3").alias("Contactor3"))


def activity_contacts_audit(crm: Crm, params: Params) -> DataFrame:
    """Visit-type activities with owner, record type and each related
    contact."""
    a = crm.activity.where(F.col("type").isin(list(params.visit_types)))
    a = role_join(a, crm.user, "owner_id", "id", {"name": "OwnerName"})
    a = a.where(kept_owner("OwnerName", params.excluded_owners, params.collation))
    a = role_join(a, crm.record_type, "record_type_id", "id", {"name": "RecordTypeName"})
    links = crm.activity_contact.select(F.col("activity_id").alias("activity_id_rc"),
                                        F.col("contact_id").alias("contact_id_rc"))
    j = bridge_left_join(a, links, "id", "activity_id_rc", known_hot=hot_keys(crm, "activity_contact"))
    return j.select(F.col("owner_id").alias("OwnerID"), "OwnerName",
                    F.col("type").alias("ActivityType"),
                    F.col("description").alias("Activity_Description"),
                    F.col("activity_date").alias("ActivityDate"),
                    F.col("system_modstamp").alias("SystemModstamp"),
                    F.col("account_id").alias("AccountID"),
                    F.col("record_type_id").alias("RecordTypeID"), "RecordTypeName",
                    F.col("status").alias("ActivityStatus"),
                    F.col("substantive").alias("Substantive_Activity"),
                    "activity_id_rc", "contact_id_rc")
