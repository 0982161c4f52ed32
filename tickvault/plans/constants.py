"""Run parameters injected into registered queries so results repeat."""

# Fixed values for repeatable runs of the registered queries.
RUN_TS = "2024-01-02 06:00:00"          # created_at / updated_at of gold rows
RUN_TS_ISO = "2024-01-02T06:00:00"      # processed_at of silver rows
RUN_DATE = "2024-01-02"
RUN_ID = "scheduled__2024-01-02T06:00:00"
