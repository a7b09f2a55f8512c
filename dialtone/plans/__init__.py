"""The eight reports, each a function from DataFrames and parameters to a DataFrame.

Modules: ``hourly`` (R1 ``hourly_call_summary``, R2 ``hourly_call_summary_w_hour``),
``agent_daily`` (R3 ``agent_productivity``, R4 ``agent_productivity_all``, R5
``agent_productivity_bu``), ``agent_events`` (R6 ``agent_events_all``, R7
``agent_events_bu``), ``call_performance`` (R8 ``call_performance``).
"""
