"""``spark-submit --py-files <zip of tradepanel> run_job.py exports|gdp|training ...``"""

from tradepanel.plans.__main__ import main

main()
