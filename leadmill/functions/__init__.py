"""Field and scoring rules: functions from columns to columns, no UDFs."""
