"""Tiny hand-made CRM tables for edge-case tests."""

from pyspark.sql.types import StructType

from fundscope.sources.standins import Crm

SCHEMAS = {
    "account": "id long, name string, district string, region string, status string, "
               "account_type string, capacity decimal(18,2), external_id string, billing_city string, "
               "billing_country string, billing_state string, billing_postal_code string",
    "user": "id long, name string, first_name string, last_name string",
    "officer": "user_id long, team_id int, level string",
    "team": "id int, name string",
    "opportunity": "id long, owner_id long, account_id long, lead_solicitor_id long, ask_date date, "
                   "ask_amount decimal(18,2), amount decimal(18,2), close_date date, name string, "
                   "division string, stage string, comment string, fiscal_year int, fiscal_quarter int, "
                   "campaign_fund string",
    "opportunity_team": "opportunity_id long, user_id long, name string, role string",
    "activity": "id long, owner_id long, contactor_1 long, contactor_2 long, contactor_3 long, "
                "type string, activity_date date, substantive string, status string, "
                "description string, account_id long, subject string, who_id long, "
                "record_type_id string, created_by long, created_date timestamp_ntz, modified_by long, "
                "modified_date timestamp_ntz, system_modstamp timestamp_ntz, gambit_key string, external_id string",
    "activity_contact": "activity_id long, contact_id long",
    "contact": "id long, account_id long, name string, label string, is_primary string, contact_type string, "
               "age int, degree string, degree_year int, school string, birthdate date, email string, pasy string, "
               "gender string, affiliations string, primary_affiliation string, religion string",
    "account_totals": "account_id long, total_gifts decimal(18,2), total_gifts_count long, "
                      "number_of_contacts long, relationship_manager long",
    "rating": "account_id long, record_type_id string, segment string",
    "record_type": "id string, name string",
    "task": "id long, account_id long, activity_date date, created_by long, "
            "created_date timestamp_ntz, modified_by long, modified_date timestamp_ntz, owner_id long, "
            "record_type_id string, type string, subtype string, system_modstamp timestamp_ntz, "
            "what_id long, who_id long, gambit_key string, external_id string",
    "goals_import": "last_first string, dollar_goal_lvl3 string, dollar_goal_lvl4 string, "
                    "dollar_goal_lvl5 string, dollar_goal_single string, visit_goal_lvl3 string, "
                    "visit_goal_lvl4 string, visit_goal_lvl5 string, visit_goal_single string, "
                    "ask_goal_lvl3 string, ask_goal_lvl4 string, ask_goal_lvl5 string, "
                    "ask_goal_single string, goal_date string, goal_fy string, "
                    "discovery_visit_goal string, dollar_goal__lvl4_fy17 string, "
                    "dollar_goal__lvl4_fy16 string, dollar_goal__lvl4_fy15 string",
}


def frame(spark, table, rows):
    schema = StructType.fromDDL(SCHEMAS[table])
    names = schema.names
    tuples = [tuple(r.get(n) for n in names) if isinstance(r, dict) else r for r in rows]
    return spark.createDataFrame(tuples, schema)


def crm(spark, **tables):
    return Crm(**{t: frame(spark, t, tables.get(t, [])) for t in SCHEMAS})
