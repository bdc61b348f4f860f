"""lonja - a retail lakehouse on Spark: landing, cleansing, quarantine, business metrics and live activity."""
