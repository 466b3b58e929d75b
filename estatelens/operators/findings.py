"""Findings of an account as an array of structs, badges, and outreach text built from them.

All of it is column expressions over the account row: no join, no Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from estatelens.config import PUBLIC_SECTOR
from estatelens.functions.text import count_phrase, epss_phrase, fixed_point

FINDING = "struct<label:string,detail:string,evidence:string,phrase:string,severity:string>"
SEVERITY = ("critical", "high", "medium")
EMAIL, INMAIL, CALL = FORMATS = ("Cold email", "LinkedIn InMail", "Call script")
TECHNICAL, EXECUTIVE = TONES = ("Urgent / technical", "Consultative / executive")

# Finding texts. {n:unit} is a counted noun. Fields: signal column, label, detail,
# evidence, phrase, severity. Order is the order of presentation.
COUNTED = {
    "datastores": ("n_exposed_datastores", "Exposed database",
                   "{n:database} reachable from the public internet", "observed",
                   "{n:database} reachable from the public internet", "critical"),
    "remote": ("n_remote_access", "Remote access exposed",
               "{n:service} — telnet, RDP, VNC, FTP or SMB", "observed",
               "{n:remote-access service} open to the internet", "critical"),
    "heartbleed": ("heartbleed_vulnerable", "Heartbleed", "Failed a direct vulnerability probe",
                   "tested", "a host failing a direct Heartbleed probe", "critical"),
    "cameras": ("n_exposed_cameras", "Exposed cameras", "{n:camera interface} reachable",
                "observed", "{n:IP camera interface} publicly reachable", "critical"),
    "open_dir": ("n_open_directories", "Open directory listing", "{n:host}", "observed",
                 "directory listings exposed on {n:host}", "high"),
    "expired": ("n_expired_certs", "Expired certificate", "{n:host} serving an expired cert",
                "observed", "{n:host} serving an expired certificate", "high"),
    "expiring": ("soonest_cert_expiry_days", "Certificate expiring", "In {n:day}", "observed",
                 "a certificate expiring in {n:day}", "medium"),
    "eol": ("n_eol_services", "End-of-life software", "{n:service} past vendor support",
            "observed", "{n:service} running software past vendor support", "high"),
    "dead_ssl": ("n_dead_ssl", "SSLv2/SSLv3 accepted", "{n:host}", "observed",
                 "{n:host} still accepting SSLv2 or SSLv3", "high"),
    "deprecated_tls": ("n_deprecated_tls", "TLS 1.0/1.1 accepted",
                       "{n:host} — a PCI-DSS finding", "observed",
                       "{n:host} still accepting TLS 1.0 or 1.1, which is a PCI-DSS finding",
                       "medium"),
    "self_signed": ("n_self_signed", "Self-signed certificate", "{n:host}", "observed",
                    "{n:host} serving a self-signed certificate", "medium"),
    "weak_sig": ("n_weak_cert_sig", "SHA-1 certificate signature", "{n:host}", "observed",
                 "{n:certificate} still signed with SHA-1", "medium"),
}
CVE_DETAIL = "{epss_precise} chance of exploitation within 30 days{cvss}"
CVE_PHRASE = ("software associated with {cve}, which carries a {epss} probability of exploitation "
              "in the next 30 days")

# Drafts, line by line. (format, tone or any, shown when, text); {slots} are filled from
# the account and its findings. Lines of a format are joined by its separator.
SEPARATOR = {EMAIL: "\n\n", INMAIL: " ", CALL: "\n"}
SEEN = {
    TECHNICAL: ("On {company}'s public infrastructure we can currently see {first}{second}. That's "
                "visible to anyone scanning, not just us."),
    EXECUTIVE: ("A quick look at {company}'s public-facing estate shows {first} — the kind of thing "
                "that tends to surface in a customer security review or an insurance renewal before "
                "it surfaces internally."),
}
RISK = {
    TECHNICAL: ("Separately, one of your public hosts is running a software version associated with "
                "{cve} — currently around a {epss} chance of being exploited in the next 30 days. "
                "That one is inferred from a version banner rather than tested, so it's worth "
                "confirming whether it actually applies."),
    EXECUTIVE: ("There is also a software version in your estate linked to a vulnerability with a "
                "{epss} chance of active exploitation this month. We infer that from a version "
                "banner rather than testing it, so treat it as a question rather than a finding."),
}
LINES = (
    (EMAIL, TECHNICAL, "always", "Subject: {lead} on {domain}"),
    (EMAIL, EXECUTIVE, "always", "Subject: Quick note on {company}'s external exposure"),
    (EMAIL, None, "always", "Hi — we track internet-facing exposure across {country}."),
    (EMAIL, None, "seen", "{seen}"),
    (EMAIL, None, "risk", "{risk}"),
    (EMAIL, TECHNICAL, "always", "Happy to walk through the detail on a short call if useful."),
    (EMAIL, EXECUTIVE, "always", "If it's useful I can send the full picture over, no call needed."),
    (INMAIL, None, "something", "Hi — we map internet-facing exposure in {country}."),
    (INMAIL, None, "seen", "{seen}"),
    (INMAIL, None, "only risk", "{risk}"),
    (INMAIL, TECHNICAL, "something", "Worth a 15-minute look?"),
    (INMAIL, EXECUTIVE, "something", "Would it be useful if I sent that across?"),
    (INMAIL, None, "nothing", "Hi — we map internet-facing exposure for organisations in {country}. "
     "Nothing urgent on {company} right now, but happy to share what we can see if useful."),
    (CALL, None, "always", 'OPEN — "Hi, calling from [vendor]. We map internet-facing exposure for '
     'organisations in {country}. Is now a bad time?"'),
    (CALL, None, "always", ""),
    (CALL, None, "always", "REASON FOR THE CALL"),
    (CALL, None, "seen", "  · {seen}"),
    (CALL, None, "unseen", "  · No observed finding — lead with the ICP fit ({hosts} hosts, {ports} "
     "open ports)."),
    (CALL, None, "risk", ""),
    (CALL, None, "risk", "IF THEY ASK WHAT ELSE"),
    (CALL, None, "risk", "  · {risk}"),
    (CALL, None, "always", ""),
    (CALL, None, "always", "PROOF POINTS — all checkable, no login required"),
    (CALL, None, "proof", "{proof}"),
    (CALL, None, "always", ""),
    (CALL, None, "always", 'QUESTION — "Who owns external attack surface for you today, and how are '
     'they finding this sort of thing?"'),
    (CALL, None, "always", ""),
    (CALL, None, "always", 'IF "WE ALREADY HAVE A VENDOR"'),
    (CALL, None, "no waf", '  · "Understood — we found this from the outside with no access. Worth '
     "checking whether it's in their scope.\""),
    (CALL, None, "waf", '  · "Understood — worth comparing what they report against what\'s '
     'externally visible."'),
)
PROOF_POINT = "  · {label}: {detail}  [{evidence}]"
DEFAULT_LEAD = "internet-facing exposure"
WITHOUT_FINDINGS = ("No specific finding to lead with for {company}. Use the call script format, which "
                    "leads on fit instead.")
# (shown when the account has, text)
CONTEXT = (
    (lambda: F.col("entity_class") == PUBLIC_SECTOR, "Public sector"),
    (lambda: F.col("no_waf_anywhere"), "No incumbent WAF"),
    (lambda: F.col("n_countries") > 1, "{n_countries} markets"),
    (lambda: F.col("publishes_securitytxt") != 0, "Publishes security.txt"),
)
# ----------------------------------------------------------------------------- end fixed values


def _fill(template: str, **slots: Column) -> Column:
    """Template with {slot} placeholders as one concat; a null slot reads as 'None'."""
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{"):
            parts.append(F.coalesce(slots[piece[1:-1]].cast("string"), F.lit("None")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def _counted(template: str, n: Column) -> Column:
    head, brace, rest = template.partition("{n:")
    if not brace:
        return F.lit(template)
    noun, _, tail = rest.partition("}")
    return F.concat(F.lit(head), count_phrase(n, noun), F.lit(tail))


def findings_column() -> Column:
    """ARRAY<finding> in presentation order; empty when nothing was seen."""
    items = []
    for key, (signal, label, detail, evidence, phrase, severity) in COUNTED.items():
        n = F.col(signal)
        present = n.between(0, 30) if key == "expiring" else n != 0
        items.append(F.when(present, F.struct(
            F.lit(label).alias("label"), _counted(detail, n).alias("detail"),
            F.lit(evidence).alias("evidence"), _counted(phrase, n).alias("phrase"),
            F.lit(severity).alias("severity"))))
    epss, cvss = F.col("max_epss"), F.col("headline_cve_cvss")
    cvss_text = F.when(cvss.isNotNull(), F.concat(F.lit(" — CVSS "), fixed_point(cvss, 1)))
    urgent = epss > F.lit(0.10).cast("float")
    items.append(F.when(epss > 0, F.struct(
        F.coalesce("headline_cve", F.lit("None")).alias("label"),
        _fill(CVE_DETAIL, epss_precise=epss_phrase(epss, precise=True),
              cvss=F.coalesce(cvss_text, F.lit(""))).alias("detail"),
        F.lit("inferred").alias("evidence"),
        _fill(CVE_PHRASE, cve=F.col("headline_cve"), epss=epss_phrase(epss)).alias("phrase"),
        F.when(urgent, "high").otherwise("medium").alias("severity"))))
    return F.array_compact(F.array(*items))


def with_findings(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("findings", findings_column())


def findings_table(accounts: DataFrame) -> DataFrame:
    """One row per finding: (entity_domain, position, label, detail, evidence, phrase, severity)."""
    source = accounts if "findings" in accounts.columns else with_findings(accounts)
    return source.select("entity_domain", F.posexplode("findings").alias("position", "f")).select(
        "entity_domain", "position", "f.*")


def context_badges() -> Column:
    """Commercial context, as opposed to what is wrong."""
    return F.array_compact(F.array(*[
        F.when(shown(), _fill(text, n_countries=F.col("n_countries"))) for shown, text in CONTEXT]))


def badges() -> Column:
    """Findings by severity, stable, then context: ARRAY<STRUCT<text, kind>>."""
    order = F.array(*[F.lit(s) for s in SEVERITY])
    keyed = F.transform("findings", lambda f, i: F.struct(
        F.array_position(order, f["severity"]).alias("severity_rank"), i.alias("place"),
        f["label"].alias("text"), f["severity"].alias("kind")))
    ranked = F.transform(F.array_sort(keyed), lambda b: F.struct(b["text"], b["kind"]))
    context = F.transform(context_badges(),
                          lambda t: F.struct(t.alias("text"), F.lit("context").alias("kind")))
    return F.concat(ranked, context)


# ----------------------------------------------------------------------------------- outreach
def outreach_text(fmt: str, tone: str, max_points: int | None = None) -> Column:
    """The draft of one format and tone. What was observed or tested is told as seen; an inferred
    finding never names the product, which may come from another service. ``max_points`` bounds
    the proof points of a call script."""
    observed = F.filter("findings", lambda f: f["evidence"].isin("observed", "tested"))
    first, second = (F.get(observed, F.lit(i))["phrase"] for i in (0, 1))
    seen = first.isNotNull()
    risk = F.exists("findings", lambda f: f["evidence"] == "inferred")
    when = {"always": F.lit(True), "seen": seen, "unseen": ~seen, "risk": risk,
            "only risk": risk & ~seen, "something": risk | seen, "nothing": ~(risk | seen),
            "proof": F.size("findings") > 0,
            "no waf": F.coalesce(F.col("no_waf_anywhere"), F.lit(False)),
            "waf": ~F.coalesce(F.col("no_waf_anywhere"), F.lit(False))}
    points = F.col("findings") if max_points is None else F.slice("findings", 1, max_points)
    proof = F.transform(points, lambda f: _fill(
        PROOF_POINT, label=f["label"], detail=f["detail"], evidence=f["evidence"]))
    slots = {
        "company": F.col("company"), "domain": F.col("entity_domain"),
        "country": F.col("primary_country_name"), "hosts": F.col("n_hosts"),
        "ports": F.col("n_ports"), "cve": F.col("headline_cve"), "epss": epss_phrase("max_epss"),
        "lead": F.coalesce(F.get("findings", F.lit(0))["label"], F.lit(DEFAULT_LEAD)),
        "first": first, "second": F.coalesce(F.concat(F.lit(", and "), second), F.lit("")),
        "proof": F.array_join(proof, SEPARATOR[CALL])}
    slots |= {"seen": _fill(SEEN[tone], **slots), "risk": _fill(RISK[tone], **slots)}
    lines = [F.when(when[shown], _fill(text, **slots)) for own, for_tone, shown, text in LINES
             if own == fmt and for_tone in (None, tone)]
    text = F.array_join(F.array_compact(F.array(*lines)), SEPARATOR[fmt])
    if fmt == CALL:                     # a script leads on fit where there is no finding
        return text
    return F.when(F.size("findings") == 0, _fill(WITHOUT_FINDINGS, **slots)).otherwise(text)


def outreach(accounts: DataFrame, formats=FORMATS, tones=TONES,
             max_points: int | None = None) -> DataFrame:
    """One row per account, format and tone. Name one of each for a single draft."""
    source = accounts if "findings" in accounts.columns else with_findings(accounts)
    drafts = F.array(*[F.struct(F.lit(f).alias("format"), F.lit(t).alias("tone"),
                                outreach_text(f, t, max_points).alias("draft"))
                       for f in formats for t in tones])
    return source.select("entity_domain", F.inline(drafts))
