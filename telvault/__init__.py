"""telvault: a Spark-native subscriber-analytics library.

Bronze landing, Data Vault staging (hubs, links, satellites), trailing-window
features, subscriber-360 / health / posture / customer-360 marts, data tests,
quality rules, data metrics, column cataloguing and a small metric layer, all
expressed as DataFrame jobs.
"""

__version__ = "0.1.0"
