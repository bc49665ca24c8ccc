"""DataFrame -> DataFrame operators: derive, upsert / keyed REPLACE,
prt_path, feature configs and roles, KPI sheets and deltas, grouped reports
and JSON trees, dependency edges."""
