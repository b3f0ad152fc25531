"""Streaming: intentionally empty.

Every report of the studied models is a full-refresh batch query: no
incremental materialisation, watermark, window over event time or state
appears anywhere. The reports here are therefore batch jobs; a scheduler
re-runs them and ``blendwise.sources.publish`` overwrites the output. Nothing
is added that the models do not do.
"""
