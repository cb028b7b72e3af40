"""A small plant batch with planted problems, and the outcome expected from it."""

MACHINES = """machine_id,machine_name,machine_type,install_date
M001,Press 1,press,2020-01-01
M002,Lathe 2,lathe,2021-05-05
M003,Mill 3,,2019-03-03
M004,,mill,2019-03-03
"""

EVENTS_HEAD = "event_id,machine_id,timestamp,product_code,quantity_produced,unit,shift\n"
EVENTS_A = """E1,M001,2026-01-01T07:00:00,PRD-A,100,units,morning
E2,M001,2026-01-01T08:00:00,PRD-A,200,kg,morning
E3,M002,2026-01-01T09:00:00,PRD-B,300,units,morning
E4,M002,1900-01-01T09:00:00,PRD-B,300,units,morning
E5,M009,2026-01-01T09:00:00,PRD-B,300,units,morning
E6,M004,2026-01-01T09:00:00,PRD-B,300,units,morning
"""
EVENTS_B = """E7,M003,2026-01-02T09:00:00,PRD-C,0,units,night
E8,M003,2026-01-02T09:00:00,PRD-C,429.5,units,night
E1,M001,2026-01-01T07:00:00,PRD-A,100,units,morning
E9,M003,not-a-date,PRD-C,50,units,night
E9,M003,2026-01-02T10:00:00,PRD-C,50,units,night
E10,M009,1900-01-01,PRD-C,-5,units,night
"""

CHECKS = """check_id,production_event_id,timestamp,result,defect_type,inspector_id
C1,E1,2026-01-01T10:00:00,pass,,INS1
C2,E1,2026-01-01T11:00:00,fail,surface_finish,
C3,E2,2026-01-01T10:00:00,pass,,INS2
C4,E4,2026-01-01T10:00:00,fail,dimension,INS1
QC-ORPHAN-1,E99,2026-01-01T10:00:00,pass,,INS1
C5,E3,1999-01-01T10:00:00,pass,,INS1
"""

MAINTENANCE = """maintenance_id,machine_id,start_time,end_time,maintenance_type,technician_id
T1,M001,2026-01-01T00:00:00,2026-01-01T02:00:00,preventive,TEC1
T2,M001,2026-01-01T01:00:00,2026-01-01T03:30:00,corrective,TEC2
T3,M002,2026-01-02T05:00:00,2026-01-02T04:00:00,inspection,TEC1
T4,M009,2026-01-02T05:00:00,2026-01-02T06:00:00,inspection,TEC1
T5,M003,2026-01-02T05:00:00,bad,inspection,TEC1
"""

FILES = {
    "machines.csv": MACHINES,
    "production_events.csv": EVENTS_HEAD + EVENTS_A + EVENTS_B,
    "quality_checks.csv": CHECKS,
    "maintenance_events.csv": MAINTENANCE,
}

FIRST_RUN = {  # inserted, skipped_duplicate, quarantined
    "machines": (3, 0, 1),
    "production_events": (4, 1, 7),
    "quality_checks": (3, 0, 3),
    "maintenance_events": (3, 0, 2),
}
SECOND_RUN = {
    "machines": (0, 3, 0),
    "production_events": (0, 5, 0),
    "quality_checks": (0, 3, 0),
    "maintenance_events": (0, 3, 0),
}

REASONS = {
    ("production_events", "E4"): "invalid or corrupted timestamp",
    ("production_events", "E5"): "unknown machine_id (foreign key would be violated)",
    ("production_events", "E6"): "unknown machine_id (foreign key would be violated)",
    ("production_events", "E7"): "physically impossible quantity_produced (<= 0)",
    ("production_events", "E8"): "missing or unparsable quantity_produced",
    ("production_events", "E9"): "invalid or corrupted timestamp",
    ("production_events", "E10"): "unknown machine_id (foreign key would be violated)",
    ("machines", "M004"): "missing required field",
    ("quality_checks", "C4"): "unknown production_event_id (foreign key would be violated)",
    ("quality_checks", "QC-ORPHAN-1"): "unknown production_event_id (foreign key would be violated)",
    ("quality_checks", "C5"): "invalid or corrupted timestamp",
    ("maintenance_events", "T4"): "unknown machine_id (foreign key would be violated)",
    ("maintenance_events", "T5"): "invalid or corrupted timestamp",
}

# (production_day_id, machine_type, events, quantity, checked, fail, defect_rate, kg)
DAILY = {
    ("M001_2026-01-01", "press", 2, 300, 2, 1, 0.5, 1),
    ("M002_2026-01-01", "lathe", 1, 300, 0, 0, None, 0),
    ("M003_2026-01-02", "", 1, 50, 0, 0, None, 0),
}
# (product, checks, pass, fail, rate, dimension, surface_finish, assembly, material)
QUALITY = {
    ("PRD-A", 2, 1, 1, 0.5, 0, 1, 0, 0),
    ("PRD-B", 0, 0, 0, None, 0, 0, 0, 0),
    ("PRD-C", 0, 0, 0, None, 0, 0, 0, 0),
}
# (machine, events, hours)
DOWNTIME = {("M001", 2, 4.5), ("M002", 1, -1.0), ("M003", 0, 0.0)}
