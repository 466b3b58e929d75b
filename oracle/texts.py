"""Texts that the statements expect, written out apart from the library's."""

FORMATS = ("Cold email", "LinkedIn InMail", "Call script")
TONES = ("Urgent / technical", "Consultative / executive")

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

SEEN_TECHNICAL = ("On {company}'s public infrastructure we can currently see {first}{second}. "
                  "That's visible to anyone scanning, not just us.")
SEEN_EXECUTIVE = ("A quick look at {company}'s public-facing estate shows {first} — the kind of "
                  "thing that tends to surface in a customer security review or an insurance "
                  "renewal before it surfaces internally.")
RISK_TECHNICAL = ("Separately, one of your public hosts is running a software version associated "
                  "with {cve} — currently around a {epss} chance of being exploited in the next "
                  "30 days. That one is inferred from a version banner rather than tested, so "
                  "it's worth confirming whether it actually applies.")
RISK_EXECUTIVE = ("There is also a software version in your estate linked to a vulnerability with "
                  "a {epss} chance of active exploitation this month. We infer that from a "
                  "version banner rather than testing it, so treat it as a question rather than "
                  "a finding.")
EMAIL_SUBJECT_TECHNICAL = "Subject: {lead} on {domain}"
EMAIL_SUBJECT_EXECUTIVE = "Subject: Quick note on {company}'s external exposure"
EMAIL_DEFAULT_LEAD = "internet-facing exposure"
EMAIL_OPEN = "Hi — we track internet-facing exposure across {country}."
EMAIL_CLOSE_TECHNICAL = "Happy to walk through the detail on a short call if useful."
EMAIL_CLOSE_EXECUTIVE = "If it's useful I can send the full picture over, no call needed."
INMAIL = "Hi — we map internet-facing exposure in {country}. {body} {closing}"
INMAIL_NOTHING = ("Hi — we map internet-facing exposure for organisations in {country}. Nothing "
                  "urgent on {company} right now, but happy to share what we can see if useful.")
INMAIL_CLOSE_TECHNICAL = "Worth a 15-minute look?"
INMAIL_CLOSE_EXECUTIVE = "Would it be useful if I sent that across?"
CALL_OPEN = ('OPEN — "Hi, calling from [vendor]. We map internet-facing exposure for '
             'organisations in {country}. Is now a bad time?"')
CALL_REASON = "REASON FOR THE CALL"
CALL_NO_FINDING = ("  · No observed finding — lead with the ICP fit ({hosts} hosts, {ports} open "
                   "ports).")
CALL_ELSE = "IF THEY ASK WHAT ELSE"
CALL_PROOF = "PROOF POINTS — all checkable, no login required"
CALL_QUESTION = ('QUESTION — "Who owns external attack surface for you today, and how are they '
                 'finding this sort of thing?"')
CALL_VENDOR = 'IF "WE ALREADY HAVE A VENDOR"'
CALL_VENDOR_NO_WAF = ('  · "Understood — we found this from the outside with no access. Worth '
                      'checking whether it\'s in their scope."')
CALL_VENDOR_WAF = ('  · "Understood — worth comparing what they report against what\'s externally '
                   'visible."')
NO_FINDING = ("No specific finding to lead with for {company}. Use the call script format, which "
              "leads on fit instead.")
