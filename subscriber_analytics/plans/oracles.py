"""The same queries in SQL for DuckDB, on the same projections."""

from __future__ import annotations

from subscriber_analytics import fixtures as fx
from subscriber_analytics.plans.registry import KPI_HOURS, STATE_COLUMNS
from subscriber_analytics.schemas import PROFILE_COLUMNS, PROFILE_DEFAULTS

_AS_OF = f"TIMESTAMP '{fx.AS_OF}'"
_STATE_COLUMNS = ", ".join(STATE_COLUMNS)


def _newest(source: str, ts: str) -> str:
    return (
        f"SELECT * FROM {source} QUALIFY "
        f"row_number() OVER (PARTITION BY customer_id ORDER BY {ts} DESC, id DESC) = 1"
    )


_TIER = (
    "CASE WHEN churn_score >= 0.7 THEN 'ELEVE' WHEN churn_score >= 0.5 THEN 'MOYEN' "
    "ELSE 'FAIBLE' END"
)

def _logs(events: str, scores: str) -> str:
    return f"""
WITH ev AS ({events}), sc AS ({scores}),
state AS ({_newest('ev', 'ingested_ts')}),
score AS (SELECT *, {_TIER} AS niveau_risque FROM ({_newest('sc', 'predicted_ts')}) s),
full_view AS (
  SELECT state.customer_id, gender, senior_citizen, partner, dependents, tenure, contract,
    payment_method, internet_service, online_security, tech_support, monthly_charges,
    total_charges, churn AS churn_observe, signup_date, churn_date,
    CAST(coalesce(churn_date, CAST({_AS_OF} AS DATE)) - signup_date AS INT) AS duree_reelle_jours,
    churn_score, churn_predicted, niveau_risque, model_version, predicted_ts
  FROM state LEFT JOIN score ON state.customer_id = score.customer_id)
"""


_LOGS = _logs(fx.ORDER_EVENTS, fx.ORDER_SCORES)
_RECENT = _logs(fx.RECENT_EVENTS, fx.RECENT_SCORES)


def _mean(value: str, digits: int) -> str:
    """Mean of values with at most four decimals, rounded half away from zero.

    In whole numbers: DuckDB divides decimals as doubles, and a tie can then fall to either side.
    """
    total = f"sum(CAST(CAST({value} AS DECIMAL(18,4)) * 10000 AS HUGEINT))"
    count = f"count({value})"
    rounded = (
        f"(2 * abs({total}) * {10 ** digits} + 10000 * {count}) // (20000 * {count})"
    )
    return f"sign({total}) * CAST({rounded} AS DOUBLE) / {10 ** digits}.0"


def _rate(label: str = "churn") -> str:
    return _mean(f"(CASE {label} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END)", 4)


def _plain(columns: str) -> str:
    """A column list with the decimals as doubles."""
    money = {"monthly_charges", "total_charges", "churn_score", "seuil_applique"}
    return ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in columns.split(", ")
    )


_TOPIC = ("CASE event_type WHEN 'usage' THEN 'usages' WHEN 'paiement' THEN 'paiements' "
          "ELSE 'abonnements' END")

_KPIS = f"""
SELECT count(*) AS nb_predictions_24h, count(DISTINCT customer_id) AS nb_clients_24h,
  {_mean('churn_score', 4)} AS score_moyen_24h,
  {_mean('churn_predicted', 4)} AS taux_churn_predit_24h,
  sum(CASE WHEN churn_score >= 0.7 THEN 1 ELSE 0 END)::BIGINT AS nb_risque_eleve_24h,
  CAST(round(sum(CASE WHEN churn_predicted = 1 THEN monthly_charges END), 2) AS DOUBLE)
    AS mrr_a_risque_24h,
  max(predicted_ts) AS derniere_prediction_ts
FROM full_view WHERE predicted_ts >= {_AS_OF} - INTERVAL '{KPI_HOURS}' HOUR
"""

_SERVICES = " + ".join(
    f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in (
        "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
        "streaming_movies")
)

_COHORTS = f"""
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS mois_cohorte, count(*) AS taille_cohorte,
  sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS churners,
  {_rate()} AS taux_churn_cohorte,
  {_mean('churn_date - signup_date', 1)} AS duree_moy_avant_churn_jours
FROM state WHERE signup_date IS NOT NULL GROUP BY 1
"""

# Profiles: stripped texts, typed, then dates and events.
_TRIMMED = ", ".join(
    f"trim(coalesce({name}, '')) AS {wire}" for name, wire in (
        ("customerID", "customer_id"), ("gender", "gender"), ("SeniorCitizen", "senior_citizen"),
        ("Partner", "partner"), ("Dependents", "dependents"), ("tenure", "tenure"),
        ("PhoneService", "phone_service"), ("MultipleLines", "multiple_lines"),
        ("InternetService", "internet_service"), ("OnlineSecurity", "online_security"),
        ("OnlineBackup", "online_backup"), ("DeviceProtection", "device_protection"),
        ("TechSupport", "tech_support"), ("StreamingTV", "streaming_tv"),
        ("Contract", "contract"), ("PaperlessBilling", "paperless_billing"),
        ("PaymentMethod", "payment_method"), ("MonthlyCharges", "monthly_charges"),
        ("TotalCharges", "total_charges"), ("Churn", "churn"))
)
_PROFILES = f"""
WITH texts AS (SELECT {_TRIMMED}, '' AS streaming_movies, c_custkey FROM ({fx.CUSTOMER_PROFILES}) p),
typed AS (SELECT * REPLACE (
    CAST(floor(coalesce(TRY_CAST(nullif(tenure, '') AS DOUBLE), 0)) AS INT) AS tenure,
    CASE senior_citizen WHEN '' THEN 0 ELSE CAST(TRY_CAST(senior_citizen AS DOUBLE) AS INT) END
      AS senior_citizen,
    coalesce(TRY_CAST(nullif(monthly_charges, '') AS DOUBLE), 0.0) AS monthly_charges,
    CASE total_charges WHEN '' THEN 0.0 ELSE TRY_CAST(total_charges AS DOUBLE) END
      AS total_charges),
  CASE WHEN senior_citizen <> '' AND TRY_CAST(TRY_CAST(senior_citizen AS DOUBLE) AS INT) IS NULL
    THEN 'senior_citizen: invalid' END AS reject_reason
  FROM texts),
signed AS (SELECT *, greatest(tenure * 30, 5) AS life,
    CAST({_AS_OF} AS DATE) - CAST(tenure * 30 + (c_custkey % 21 - 10) AS INT) AS signup_date
  FROM typed WHERE reject_reason IS NULL),
dated AS (SELECT *, CASE WHEN churn = 'Yes' THEN least(
      signup_date + CAST(life * 6 // 10 + (c_custkey * 48271) % (life - life * 6 // 10 + 1) AS INT),
      CAST({_AS_OF} AS DATE) - 1) END AS churn_date
  FROM signed),
emitted AS (
  SELECT * REPLACE ('No' AS churn, CAST(NULL AS DATE) AS churn_date), 'abonnement' AS event_type,
    {_AS_OF} AS event_ts FROM dated
  UNION ALL
  SELECT *, 'resiliation', {_AS_OF} + INTERVAL '1' MICROSECOND FROM dated WHERE churn = 'Yes'),
refused AS (SELECT *, CAST(NULL AS DATE) AS signup_date, CAST(NULL AS DATE) AS churn_date FROM typed
  WHERE reject_reason IS NOT NULL)
"""

_REQUESTS = f"""
WITH asked AS ({fx.CUSTOMER_REQUESTS}),
filled AS (SELECT c_custkey, coalesce(gender, 'Male') AS gender,
  coalesce(SeniorCitizen, 0) AS SeniorCitizen, 'No' AS Partner, 'No' AS Dependents, tenure,
  'Yes' AS PhoneService, 'No' AS MultipleLines, 'Fiber optic' AS InternetService, OnlineSecurity,
  'No' AS OnlineBackup, 'No' AS DeviceProtection, 'No' AS TechSupport, 'No' AS StreamingTV,
  'No' AS StreamingMovies, coalesce(Contract, 'Month-to-month') AS Contract,
  'Yes' AS PaperlessBilling, 'Electronic check' AS PaymentMethod, MonthlyCharges, TotalCharges,
  nullif(concat_ws('; ',
    CASE WHEN tenure IS NULL THEN 'tenure: missing' WHEN tenure > 100 THEN 'tenure: out of range' END,
    CASE WHEN isnan(MonthlyCharges) THEN 'MonthlyCharges: out of range' END,
    CASE WHEN TotalCharges < 0 THEN 'TotalCharges: out of range' END), '') AS reject_reason
  FROM asked)
"""

_RAW = f"""
WITH raw AS ({fx.ORDER_RAW_EVENTS})
SELECT id, customer_id, CASE WHEN length(gender) <= 10 THEN gender END AS gender,
  CASE WHEN senior_citizen <= 32767 THEN senior_citizen END AS senior_citizen,
  substring(partner, 1, 3) AS partner, tenure,
  CASE WHEN monthly_charges < 1000000 THEN monthly_charges END AS monthly_charges,
  TRY_CAST(signup_date AS DATE) AS signup_date, 'abonnement' AS event_type, event_ts,
  'kafka_simulator' AS source,
  nullif(concat_ws('; ',
    CASE WHEN customer_id IS NULL THEN 'customer_id: missing' END,
    CASE WHEN length(gender) > 10 THEN 'gender: too long' END,
    CASE WHEN senior_citizen > 32767 THEN 'senior_citizen: invalid' END,
    CASE WHEN monthly_charges >= 1000000 AND NOT isnan(monthly_charges)
      THEN 'monthly_charges: invalid' END,
    CASE WHEN TRY_CAST(signup_date AS DATE) IS NULL THEN 'signup_date: invalid' END,
    CASE WHEN event_ts IS NULL THEN 'event_ts: missing' END), '') AS reject_reason
FROM raw
"""

# Stream: the messages after parsing, and the reason of each rejected one.
_MESSAGES = f"""
WITH fields AS ({fx.EVENT_FIELDS}),
parsed AS (SELECT event_id, ts,
    CASE WHEN broken = '' THEN 'message: empty' WHEN broken IS NOT NULL THEN 'message: malformed' END
      AS message_reason,
    CASE WHEN NOT text_tenure THEN tenure END AS tenure_read,
    CASE WHEN NOT no_time THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS time_text,
    * EXCLUDE (event_id, ts, tenure, no_time, broken, text_tenure)
  FROM fields),
checked AS (SELECT *, coalesce(message_reason, nullif(concat_ws('; ',
    CASE WHEN customer_id IS NULL THEN 'customer_id: missing' END,
    CASE WHEN length(contract) > 20 THEN 'contract: too long' END,
    CASE WHEN TRY_CAST(signup_date AS DATE) IS NULL THEN 'signup_date: invalid' END,
    CASE WHEN time_text IS NULL THEN 'event_ts: missing' END), '')) AS reject_reason
  FROM parsed),
good AS (SELECT * EXCLUDE (
      signup_date, churn_date, tenure_read, monthly_charges, total_charges, senior_citizen),
    CAST(senior_citizen AS SMALLINT) AS senior_citizen,
    tenure_read AS tenure, CAST(signup_date AS DATE) AS signup_date,
    CAST(churn_date AS DATE) AS churn_date,
    CAST(monthly_charges AS DECIMAL(8,2)) AS monthly_charges,
    CAST(total_charges AS DECIMAL(10,2)) AS total_charges
  FROM checked WHERE reject_reason IS NULL),
firsts AS (SELECT *, CASE WHEN tenure < 6 THEN 1 ELSE 0 END AS is_new, {_SERVICES} AS services
  FROM good
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ts, event_id) = 1),
scored AS (SELECT *, 1 / (1 + exp(-(-1.0 + 0.01 * CAST(coalesce(monthly_charges, 0) AS DOUBLE)
    - 0.02 * coalesce(tenure, 0) + 0.3 * is_new - 0.1 * services + 0.2 * senior_citizen
    + CASE contract WHEN 'Month-to-month' THEN 0.6 WHEN 'Two year' THEN -0.8 ELSE 0 END))) AS p
  FROM firsts)
"""

_JSON_COLUMNS = ", ".join(
    {
        "tenure": "CASE WHEN message_reason IS NULL THEN tenure_read END AS tenure",
        "event_ts": "CASE WHEN message_reason IS NULL THEN time_text END AS event_ts",
    }.get(c, f"CASE WHEN message_reason IS NULL THEN {c} END AS {c}")
    for c in PROFILE_COLUMNS + ("signup_date", "churn_date", "event_type", "event_ts", "source")
)

_FEED = f"""{_LOGS} SELECT f.customer_id, f.event_type, f.event_ts,
    CAST(score.churn_score AS DOUBLE) AS churn_score
    FROM (SELECT * FROM ev ORDER BY ingested_ts DESC, id DESC LIMIT 50) f
    LEFT JOIN score ON score.customer_id = f.customer_id"""
_RECENT_FEED = _FEED.replace(
    "FROM ev ORDER", f"FROM ev WHERE CAST(ingested_ts AS DATE) >= CAST({_AS_OF} AS DATE) - 30 ORDER")

# All grouped reports with one set of columns.
_GROUPED = {
    "contract": ("contract", "TRUE"),
    "tranche": ("CASE WHEN tenure < 0 THEN 0 WHEN tenure >= 72 THEN 13 ELSE CAST(floor(tenure * 12 / 72.0) AS INT) + 1 END", "TRUE"),
    "nb_services": (_SERVICES, "TRUE"),
    "mois_cohorte": ("CAST(date_trunc('month', signup_date) AS DATE)", "signup_date IS NOT NULL"),
    "semaine": ("CAST(date_trunc('week', churn_date) AS DATE)", "churn = 'Yes' AND churn_date IS NOT NULL"),
}
_GROUP_TYPES = {"contract": "VARCHAR", "tranche": "INT", "nb_services": "INT", "mois_cohorte": "DATE", "semaine": "DATE"}


def _grouped(report: str, key: str, where: str) -> str:
    names = ", ".join(
        f"CAST({key if name == report else 'NULL'} AS {kind}) AS {name}" for name, kind in _GROUP_TYPES.items())
    return f"""SELECT {names}, '{report}' AS rapport, count(*) AS nb_clients,
        sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS nb_churn, {_rate()} AS taux_churn,
        min(tenure) AS borne_basse, max(tenure) AS borne_haute, {_mean('churn_date - signup_date', 1)} AS duree_moyenne_jours,
        {_mean('monthly_charges', 2)} AS mrr_moyen FROM state WHERE {where} GROUP BY {key}"""

ORACLES: dict[str, str] = {
    "rate_by_contract": f"""{_LOGS}
        SELECT contract, count(*) AS nb_clients,
          sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS nb_churn,
          {_rate()} AS taux_churn FROM state GROUP BY contract""",
    "latest_state": f"{_LOGS} SELECT {_plain(_STATE_COLUMNS)} FROM state",
    "merged_state": f"{_LOGS} SELECT {_plain(_STATE_COLUMNS)} FROM state",
    "latest_score": f"""{_LOGS} SELECT customer_id, CAST(churn_score AS DOUBLE) AS churn_score,
        churn_predicted, CAST(seuil_applique AS DOUBLE) AS seuil_applique, model_version,
        predicted_ts, niveau_risque FROM score""",
    "customer_360": f"""{_LOGS} SELECT * REPLACE (CAST(monthly_charges AS DOUBLE) AS monthly_charges,
        CAST(total_charges AS DOUBLE) AS total_charges, CAST(churn_score AS DOUBLE) AS churn_score)
        FROM full_view""",
    "score_lookup": f"""{_LOGS} SELECT customer_id, CAST(churn_score AS DOUBLE) AS churn_score,
        churn_predicted, model_version, predicted_ts FROM score WHERE customer_id = '7'""",
    "live_feed": _FEED,
    "live_feed_recent": _RECENT_FEED,
    "view_query": f"""{_LOGS} SELECT niveau_risque, contract, count(*) AS n,
        max(duree_reelle_jours) AS plus_longue FROM full_view WHERE tenure >= 12
        GROUP BY niveau_risque, contract""",
    "actual_vs_predicted": f"""{_LOGS} SELECT model_version, count(*) AS clients_evalues,
        sum(CASE WHEN churn_observe = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS actual_churns,
        sum(churn_predicted)::BIGINT AS predicted_churns,
        {_mean("CASE WHEN (churn_observe = 'Yes' AND churn_predicted = 1) OR (churn_observe = 'No' AND churn_predicted = 0) THEN 1 ELSE 0 END", 4)} AS accuracy_live,
        {_mean('churn_score', 4)} AS score_moyen
        FROM full_view WHERE churn_score IS NOT NULL GROUP BY model_version""",
    "customers_at_risk": f"""{_LOGS} SELECT customer_id, CAST(churn_score AS DOUBLE) AS churn_score,
        niveau_risque, contract, tenure, CAST(monthly_charges AS DOUBLE) AS mrr, signup_date,
        predicted_ts FROM full_view WHERE churn_predicted = 1
        ORDER BY full_view.churn_score DESC, customer_id LIMIT 50""",
    "live_kpis": f"{_LOGS} {_KPIS}",
    "live_kpis_from_logs": f"{_LOGS} {_KPIS}",
    "rate_by_tenure": f"""{_LOGS} SELECT CASE WHEN tenure < 0 THEN 0 WHEN tenure >= 72 THEN 13
          ELSE CAST(floor(tenure * 12 / 72.0) AS INT) + 1 END AS tranche,
        min(tenure) AS borne_basse, max(tenure) AS borne_haute, count(*) AS nb_clients,
        {_rate()} AS taux_churn FROM state GROUP BY 1""",
    "rate_by_services": f"""{_LOGS} SELECT {_SERVICES} AS nb_services, count(*) AS nb_clients,
        {_rate()} AS taux_churn FROM state GROUP BY 1""",
    "cohort_retention": f"{_LOGS} {_COHORTS}",
    "recent_cohorts": f"{_LOGS} {_COHORTS} ORDER BY mois_cohorte DESC LIMIT 12",
    "churn_velocity": f"""{_LOGS} SELECT contract, count(*) AS nb_churners,
        {_mean('churn_date - signup_date', 1)} AS delai_moyen_jours,
        CAST(round(quantile_cont(churn_date - signup_date, 0.5), 1) AS DOUBLE) AS delai_median_jours
        FROM state WHERE churn = 'Yes' AND churn_date IS NOT NULL AND signup_date IS NOT NULL
        GROUP BY contract""",
    "weekly_trend": f"""{_LOGS} SELECT CAST(date_trunc('week', churn_date) AS DATE) AS semaine,
        count(*) AS nb_churns, {_mean('monthly_charges', 2)} AS mrr_moyen_perdu
        FROM state WHERE churn = 'Yes' AND churn_date IS NOT NULL GROUP BY 1""",
    "base_summary": f"""{_LOGS} SELECT count(*) AS clients_en_base, {_rate()} AS taux_churn_observe,
        sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)::BIGINT AS nb_resiliations,
        CAST(round(sum(monthly_charges) / 1000000.0, 2) AS DOUBLE) AS mrr_total_meur,
        {_mean('monthly_charges', 2)} AS mrr_moyen, {_mean('tenure', 1)} AS anciennete_moyenne,
        CAST(round(quantile_cont(tenure, 0.5), 1) AS DOUBLE) AS anciennete_mediane FROM state""",
    "typed_profiles": f"{_PROFILES} SELECT {', '.join(PROFILE_COLUMNS)}, reject_reason FROM typed",
    "validated_profiles": f"""{_REQUESTS} SELECT c_custkey, {', '.join(PROFILE_DEFAULTS)},
        reject_reason FROM filled""",
    "constraint_rejects": _RAW.replace(
        "THEN monthly_charges END AS monthly_charges",
        "THEN CAST(CAST(monthly_charges AS DECIMAL(8,2)) AS DOUBLE) END AS monthly_charges"),
    "features": f"""WITH p AS ({fx.ORDER_PROFILES})
        SELECT * REPLACE (TRY_CAST(nullif(TotalCharges, '') AS DOUBLE) AS TotalCharges),
        CASE WHEN tenure < 6 THEN 1 ELSE 0 END AS NewClient,
        (CASE WHEN OnlineSecurity = 'Yes' THEN 1 ELSE 0 END)
        + (CASE WHEN TechSupport = 'Yes' THEN 1 ELSE 0 END)
        + (CASE WHEN StreamingTV = 'Yes' THEN 1 ELSE 0 END) AS NbServices
        FROM p QUALIFY row_number() OVER (PARTITION BY customerID ORDER BY o_orderkey) = 1""",
    "scored_profiles": f"""{_REQUESTS}, s AS (SELECT c_custkey, 1 / (1 + exp(-(-1.0
          + 0.01 * MonthlyCharges - 0.02 * tenure + 0.3 * (CASE WHEN tenure < 6 THEN 1 ELSE 0 END)
          - 0.1 * (CASE WHEN OnlineSecurity = 'Yes' THEN 1 ELSE 0 END) + 0.2 * SeniorCitizen
          + CASE Contract WHEN 'Month-to-month' THEN 0.6 WHEN 'Two year' THEN -0.8 ELSE 0 END)))
          AS p FROM filled WHERE reject_reason IS NULL)
        SELECT filled.c_custkey, round(p, 4) AS churn_score, p >= 0.5 AS churn_predicted,
        CASE WHEN p IS NULL THEN NULL WHEN round(p, 4) >= 0.7 THEN 'ELEVE' WHEN round(p, 4) >= 0.5 THEN 'MOYEN'
          ELSE 'FAIBLE' END AS niveau_risque, CAST(0.5 AS DOUBLE) AS seuil_applique, reject_reason
        FROM filled LEFT JOIN s ON filled.c_custkey = s.c_custkey""",
    "lifecycle_dates": f"""{_PROFILES} SELECT customer_id, tenure, total_charges, churn, signup_date,
        churn_date, reject_reason FROM dated
        UNION ALL SELECT customer_id, tenure, total_charges, churn, signup_date, churn_date, reject_reason FROM refused""",
    "lifecycle_events": f"""{_PROFILES} SELECT {', '.join(PROFILE_COLUMNS)}, signup_date, churn_date,
        event_type, event_ts, 'replay' AS source, reject_reason FROM emitted
        UNION ALL SELECT {', '.join(PROFILE_COLUMNS)}, signup_date, churn_date, NULL, NULL, 'replay', reject_reason
        FROM refused""",
    "event_routing": f"""WITH ev AS ({fx.ORDER_EVENTS})
        SELECT {_TOPIC} AS topic, customer_id AS key, event_type,
        strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_ts,
        CAST(signup_date AS VARCHAR) AS signup_date, churn, tenure,
        CAST(monthly_charges AS DOUBLE) AS monthly_charges, churn_date IS NULL AS null_churn_date,
        contract IS NULL AS null_contract FROM ev""",
    "publish_roundtrip": f"""WITH ev AS ({fx.ORDER_EVENTS}), routed AS (SELECT *, {_TOPIC} AS topic FROM ev)
        SELECT id, {_plain(', '.join(PROFILE_COLUMNS))}, signup_date, churn_date, event_type, event_ts, source
        FROM routed QUALIFY row_number() OVER (
          PARTITION BY customer_id ORDER BY event_ts DESC, topic DESC, id DESC) = 1""",
    "retention_window": f"""WITH ev AS ({fx.ORDER_EVENTS}) SELECT id, customer_id, ingested_ts FROM ev
        WHERE ingested_ts >= {_AS_OF} - INTERVAL '7' DAY""",
    "stream_parsed": f"""{_MESSAGES} SELECT event_id, {_JSON_COLUMNS},
        message_reason AS reject_reason FROM checked""",
    "stream_event_log": f"""{_MESSAGES} SELECT event_id, {_plain(', '.join(PROFILE_COLUMNS))},
        signup_date, churn_date, event_type, ts AS event_ts, source FROM good""",
    "stream_rejects": f"""{_MESSAGES} SELECT event_id,
        CASE WHEN message_reason IS NULL THEN customer_id END AS customer_id, reject_reason
        FROM checked WHERE reject_reason IS NOT NULL""",
    "stream_scored": f"""{_MESSAGES} SELECT event_id, customer_id, round(p, 4) AS churn_score,
        CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS SMALLINT) AS churn_predicted,
        CAST(0.5 AS DOUBLE) AS seuil_applique, 'churn_model' AS model_name, '1' AS model_version,
        ts AS event_ts FROM scored""",
    "stream_360": f"""{_MESSAGES}, last_event AS (SELECT * FROM good
          QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT l.customer_id, l.gender, l.senior_citizen, l.partner, l.dependents, l.tenure,
        l.contract, l.payment_method, l.internet_service, l.online_security, l.tech_support,
        CAST(l.monthly_charges AS DOUBLE) AS monthly_charges,
        CAST(l.total_charges AS DOUBLE) AS total_charges, l.churn AS churn_observe, l.signup_date,
        l.churn_date,
        CAST(coalesce(l.churn_date, DATE '2024-02-01') - l.signup_date AS INT) AS duree_reelle_jours,
        round(p, 4) AS churn_score,
        CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS SMALLINT) AS churn_predicted,
        CASE WHEN round(p, 4) >= 0.7 THEN 'ELEVE' WHEN round(p, 4) >= 0.5 THEN 'MOYEN'
          ELSE 'FAIBLE' END AS niveau_risque, '1' AS model_version
        FROM last_event l LEFT JOIN scored s ON l.customer_id = s.customer_id""",
    "batch_dedupe": """SELECT CAST(ts AS DATE) AS batch_day, user_id, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY event_id) = 1""",
    "batch_metrics": """WITH s AS (SELECT CAST(ts AS DATE) AS batch_day,
          1 / (1 + exp(-(-1.0 + 0.01 * value))) AS p, round(p, 4) AS score FROM events)
        SELECT batch_day, count(*) AS nb_scores,
        sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS nb_a_risque,
        """ + _mean("score", 3) + " AS score_moyen FROM s GROUP BY 1",
}


_DAILY = _MESSAGES.replace("PARTITION BY customer_id ORDER BY ts", "PARTITION BY CAST(ts AS DATE), customer_id ORDER BY ts")

ORACLES |= {
    "all_rates": f"{_LOGS} " + " UNION ALL ".join(
        [_grouped(report, key, where) for report, (key, where) in _GROUPED.items()]
        + [_grouped("base", "()", "TRUE")]),
    "rates_in_order": f"""{_LOGS}, r AS ({ORACLES['rate_by_contract'].removeprefix(_LOGS)})
        SELECT *, row_number() OVER (ORDER BY taux_churn DESC NULLS FIRST, contract NULLS FIRST) AS place FROM r""",
    "bands_in_order": f"""{_LOGS}, r AS ({ORACLES['rate_by_tenure'].removeprefix(_LOGS)})
        SELECT *, row_number() OVER (ORDER BY tranche NULLS LAST) AS place FROM r""",
    "first_report_row": f"""{ORACLES['rate_by_contract']}
        ORDER BY taux_churn DESC NULLS FIRST, contract NULLS FIRST LIMIT 1""",
    "first_profiles": f"{_PROFILES} SELECT customer_id, tenure, contract FROM typed ORDER BY customer_id LIMIT 100",
    "padded_features": ORACLES["features"],
    "fallback_scored": ORACLES["scored_profiles"],
    "bucketed_360": ORACLES["customer_360"],
    "profile_files": ORACLES["typed_profiles"],
    "published_profiles": f"""{_PROFILES.replace(fx.CUSTOMER_PROFILES, fx.DATED_PROFILES)}
        SELECT customer_id, CAST(senior_citizen AS SMALLINT) AS senior_citizen, tenure, contract,
          CAST(CAST(monthly_charges AS DECIMAL(8,2)) AS DOUBLE) AS monthly_charges,
          CAST(CAST(total_charges AS DECIMAL(10,2)) AS DOUBLE) AS total_charges, churn,
          DATE '1999-01-01' + CAST(c_custkey % 500 AS INT) AS signup_date,
          CASE WHEN churn = 'Yes' THEN DATE '2000-06-01' + CAST(c_custkey % 300 AS INT) END AS churn_date,
          CASE WHEN churn = 'Yes' THEN 'resiliation' ELSE 'abonnement' END AS event_type,
          {_AS_OF} + INTERVAL '1' MICROSECOND * (CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END) AS event_ts,
          'replay' AS source, reject_reason FROM typed WHERE reject_reason IS NULL
        UNION ALL SELECT customer_id, senior_citizen, tenure, contract, monthly_charges, total_charges, churn,
          NULL, NULL, NULL, NULL, 'replay', reject_reason FROM typed WHERE reject_reason IS NOT NULL""",
    "exported_reports": f"{_RECENT} " + " UNION ALL ".join(
        f"SELECT '{name}' AS rapport, CAST({group} AS VARCHAR) AS groupe, CAST({count} AS BIGINT) AS nombre, "
        f"CAST({figure} AS DOUBLE) AS valeur FROM ({sql.removeprefix(_LOGS)}) {name}"
        for name, group, count, figure, sql in (
            ("rate_by_contract", "contract", "nb_clients", "taux_churn", ORACLES["rate_by_contract"]),
            ("rate_by_services", "nb_services", "nb_clients", "taux_churn", ORACLES["rate_by_services"]),
            ("cohort_retention", "mois_cohorte", "taille_cohorte", "duree_moy_avant_churn_jours", ORACLES["cohort_retention"]),
            ("weekly_trend", "semaine", "nb_churns", "mrr_moyen_perdu", ORACLES["weekly_trend"]),
            ("churn_velocity", "contract", "nb_churners", "delai_moyen_jours", ORACLES["churn_velocity"]),
            ("actual_vs_predicted", "model_version", "clients_evalues", "score_moyen", ORACLES["actual_vs_predicted"]),
            ("customers_at_risk", "customer_id", "tenure", "churn_score",
             "SELECT customer_id, tenure, churn_score FROM full_view WHERE churn_predicted = 1"))),
    "log_feed": _RECENT_FEED.replace(_LOGS, _RECENT),
    "log_kpis": f"{_RECENT} {_KPIS}",
    "log_retention": f"""WITH ev AS ({fx.RECENT_EVENTS}) SELECT id, customer_id, ingested_ts FROM ev
        WHERE ingested_ts >= {_AS_OF} - INTERVAL '7' DAY""",
    "log_score_lookup": ORACLES["score_lookup"].replace(_LOGS, _RECENT),
    "job_by_day": f"""{_DAILY}, counts AS (SELECT CAST(ts AS DATE) AS jour,
          count(*) FILTER (reject_reason IS NULL) AS nb_evenements,
          count(*) FILTER (reject_reason IS NOT NULL) AS nb_rejets FROM checked GROUP BY 1),
        means AS (SELECT CAST(ts AS DATE) AS jour, count(*) AS nb_scores,
          sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS nb_a_risque, {_mean('round(p, 4)', 3)} AS score_moyen
          FROM scored GROUP BY 1)
        SELECT CAST(ts AS DATE) AS jour, event_id, customer_id, round(p, 4) AS churn_score,
          CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS SMALLINT) AS churn_predicted,
          nb_evenements, nb_rejets, nb_scores, nb_a_risque, score_moyen
        FROM scored JOIN counts ON CAST(ts AS DATE) = counts.jour JOIN means ON counts.jour = means.jour""",
    "stream_latest_state": ORACLES["publish_roundtrip"],
    "restart_roundtrip": f"""WITH whole AS ({ORACLES['publish_roundtrip']}), ev AS ({fx.ORDER_EVENTS})
        SELECT whole.*, nb_evenements, TRUE AS un_score_par_lot FROM whole
        JOIN (SELECT customer_id, count(*) AS nb_evenements FROM ev GROUP BY 1) USING (customer_id)""",
    "replay_roundtrip": ORACLES["stream_scored"],
    "pipeline_scored": f"{_MESSAGES} SELECT event_id, customer_id, TRUE AS same_score FROM firsts",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
