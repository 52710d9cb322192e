"""Readers: driver/stored tables, bill-detail exports, landed API/BSS feeds, logs."""
