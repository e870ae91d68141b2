"""Names, codes and patterns of the open-data files.

Fixed values: everything in this module must equal what the published files
use (headers, territory codes, year list, file names), or results differ.
"""

from __future__ import annotations

# -- column headers -------------------------------------------------------
COMMUNE_CODE = "CODGEO"
COMMUNE_LABEL = "LIBGEO"
COMMUNE_PART = "Code de la commune"
DEPARTMENT = "Code département"
DEPARTMENT_LABEL = "Libellé du département"
REGION = "Code région"
YEAR = "annee"
TYPE = "type"
DATA = "data"
INDICATOR = "indicateur"
UNIT = "unite de compte"
RATE = "taux pour mille"
TURNOUT = "% Exp/Ins"

# -- geography file -------------------------------------------------------
GEO_COMMUNE_LABEL = "Libellé Commune"
GEO_POINT = "Geo Point"
GEO_DEPARTMENT_LABEL = "Libellé département"

# -- election files -------------------------------------------------------
CANDIDATE_PREFIX = "Nuance candidat "
VOTE_SHARE_PREFIX = "% Voix/exprimés "
REFERENCE_CODE = "Code"
REFERENCE_CAMP = "Orientation"
LEFT = "gauche"
RIGHT = "droite"
SCORE_LEFT = "Score_Gauche"
SCORE_RIGHT = "Score_Droite"
SCORE_OTHER = "Score_Divers"

# -- metric headers and the names they are published under ------------------
POVERTY_METRIC = "Taux de bas revenus déclarés au seuil de 60 %"
POVERTY_MEAN = "taux_pauvrete_commune"
SOCIAL_METRIC = "IPS Ensemble GT-PRO"
SOCIAL_MEAN = "indice_position_sociale"
POPULATION = "population_totale"
UNIVERSITY_SHARE = "taux_diplome_universitaire_total"
SCHOOL_SHARE = "taux_bac_ou_moins_total"
UNIVERSITY_SHARE_YOUNG = "taux_universitaire_16_24_ans"
SCHOOL_SHARE_YOUNG = "taux_bac_ou_moins_16_24_ans"
UNIVERSITY_SHARE_ADULT = "taux_universitaire_25_ans_et_plus"
SCHOOL_SHARE_ADULT = "taux_bac_ou_moins_25_ans_et_plus"
YOUNG_SUFFIX = "_rec1rpop2021"
ADULT_SUFFIX = "_rec2rpop2021"

# -- territory and years ----------------------------------------------------
DEPARTMENTS = (22, 29, 35, 44, 56)
REGIONS = (53,)
YEARS = (2017, 2022, 2024)

# -- dimensions and fact table ------------------------------------------------
DEPARTMENT_TABLE = "Departement"
COMMUNE_TABLE = "Commune"
# Not in the published database: the région of each département.
REGION_TABLE = "Region"
FACT_TABLE = "Donnees_commune"
DEPARTMENT_DDL = "code_dep INT NOT NULL, nom_dep VARCHAR(255)"
COMMUNE_DDL = "code_com VARCHAR(5) NOT NULL, nom_com VARCHAR(255), geo_point VARCHAR(100), code_dep INT NOT NULL"

# -- input and output files -----------------------------------------------------
REFERENCE_FILE = "ReferenceDroiteGauche.csv"
GEOGRAPHY_FILE = "FichierReferenceCommunesDepartement/communes-france.csv"
ELECTIONS = "FinalResultsDatasLeg"
YEARLY_DATASETS = ("CarteLoyer", "ProductionEnergetique", "UniteUrbaine")
POVERTY_FILE = "niveau-pauvrete-par-commune"
EDUCATION_FILE = "population-selon-niveau-etude-par-commune"
EDUCATION_OUTPUT = "population-niveau-etude-par-commune"
CRIME_FILE = "criminalite-par-region"
SOCIAL_FILE = "indice-position-sociale-lycee-par-commune"
READY_INPUT = "ReadyForDataBase"
READY_OUTPUT = "ReadyForDataBaseCsv"
