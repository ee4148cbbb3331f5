from crewcast.catalog import chains, correction, daily, efficiency, facts, history, labels, publish, seasonal, series, storage, wide
from crewcast.catalog.base import ORACLES, QUERIES
