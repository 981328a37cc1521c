"""Layer and table names, and the storage format of managed tables."""

BRONZE = "bronze"
SILVER = "silver"
GOLD = "gold"

FLEET_TABLE = f"{BRONZE}.frota_raw"
MUNICIPALITY_TABLE = f"{BRONZE}.rfb_municipios"
# Lines of the files that do not fit a raw table's schema are in a table named with this suffix.
REJECTED_SUFFIX = "_rejeitadas"

# "delta" works too where the session has the connector; plain Spark ships parquet.
TABLE_FORMAT = "parquet"
