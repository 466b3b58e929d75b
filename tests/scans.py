"""Hand-written scan rows: only the columns a test names, defaults for the rest."""

from estatelens import schemas

ARRAYS = {"hostnames", "domains", "cpe23", "tags", "cves", "http_components", "ssl_versions",
          "services"}
DEFAULTS = {"port": 80, "transport": "tcp", "n_cves": 0, "n_cves_critical": 0, "n_cves_high": 0,
            "n_cves_verified": 0, "has_securitytxt": False, "ssl_expired": False}


def scan(spark, rows):
    names = schemas.names(schemas.SCAN)
    filled = [tuple(r.get(n, [] if n in ARRAYS else DEFAULTS.get(n)) for n in names) for r in rows]
    return spark.createDataFrame(filled, schemas.SCAN)
