"""Part of rollbook: facility panels and corpora on Spark."""
