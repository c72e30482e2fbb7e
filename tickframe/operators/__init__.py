"""Indicator, EWM, rolling-window and screen operators."""
