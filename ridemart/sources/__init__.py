"""Sources and sinks (S1-S20): raw trip files, zone inputs, tables, exports."""
