"""Session settings that suit wide contract plans. Each can be overridden."""

from __future__ import annotations

# Wide rows make wide generated methods. Above 8000 bytes the JVM interprets a
# method instead of compiling it, so such plans are better off with operators
# that split their code; and a base of sixty columns needs more cached classes
# than the default, or each refresh compiles them anew.
SESSION_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder):
    """Apply the settings to a ``SparkSession.builder``."""
    for name, value in SESSION_CONF.items():
        builder = builder.config(name, value)
    return builder
