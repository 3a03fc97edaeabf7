"""Fixed word lists for names of people in Spanish texts."""

from __future__ import annotations

import unicodedata

#: Usual given names of the Río de la Plata.
GIVEN_NAMES = """
Adolfo Adriana Agustín Alberto Alejandra Alejandro Alicia Ana Analía Andrea Andrés Ángel Antonia Antonio Bautista Beatriz
Camila Carlos Carmen Carolina Cecilia Claudia Claudio Concepción Cristina Daniel Darío Diego Dolores Eduardo Elena Elsa
Emilia Enrique Ernesto Esteban Estela Ezequiel Facundo Federico Felipe Fernando Florencia Francisco Gabriel Gabriela
Gonzalo Graciela Guadalupe Guillermo Gustavo Héctor Hernán Hugo Ignacio Isabel Javier Joaquín Jorge José Josefina Juan
Julia Julieta Julio Laura Leandro Lidia Liliana Lucas Lucía Luciana Luis Luisa Manuel Marcelo Marcos Margarita María
Mariana Mariano Mariela Marina Mario Marta Martín Matías Mauricio Maximiliano Mercedes Miguel Mirta Natalia Nicolás Norma
Olga Oscar Pablo Patricia Paula Pedro Pilar Rafael Ramón Raúl Ricardo Roberto Rocío Rosa Rosario Rubén Santiago Sebastián
Sergio Silvia Sofía Soledad Susana Teresa Tomás Valeria Verónica Victoria Viviana Walter Ximena Zulema
""".split()

#: Short forms by full name.
NICKNAMES = {
    "Alejandra": "Ale", "Alejandro": "Ale Jano", "Beatriz": "Betty Bea", "Francisco": "Pancho Fco Paco", "Gabriela": "Gaby",
    "Gabriel": "Gabi Gaby", "Mercedes": "Mecha Merceditas", "Ignacio": "Nacho", "Graciela": "Chela", "Rosario": "Charo",
    "Guadalupe": "Gpe Lupe Guada", "Ezequiel": "Eze", "Santiago": "Santi", "Nicolás": "Nico", "Joaquín": "Joaco",
    "Alberto": "Beto Tito", "Roberto": "Beto Tito", "Florencia": "Flor Flo", "Maximiliano": "Maxi", "Paula": "Pau",
    "Isabel": "Isa Chabela", "Facundo": "Facu", "Federico": "Fede", "Guillermo": "Guille Willy Memo", "Manuel": "Manolo Manu",
    "José": "Pepe", "Josefina": "Pepa Jose", "Dolores": "Lola", "Concepción": "Concha Conchita", "Rafael": "Rafa",
    "Sebastián": "Seba", "Susana": "Susi", "Teresa": "Tere", "Victoria": "Vicky", "Carolina": "Caro", "María": "Mª Ma",
    "Eduardo": "Edu Lalo", "Enrique": "Quique", "Cecilia": "Ceci", "Julieta": "Juli", "Luciana": "Lu Luli",
    "Verónica": "Vero", "Patricia": "Pato Patri", "Ricardo": "Richard Ricky Cacho", "Mauricio": "Mauri", "Soledad": "Sole",
    "Rocío": "Ro", "Pilar": "Pili", "Antonio": "Tony Toni Toño", "Antonia": "Toñi Anto", "Mariano": "Nano", "Ramón": "Moncho",
    "Gonzalo": "Gonza", "Luis": "Lucho", "Juan": "Juancho", "Martín": "Tincho", "Adolfo": "Fito", "Leandro": "Lean",
    "Zulema": "Zule", "Ximena": "Xime", "Claudia": "Clau", "Silvia": "Silvi", "Andrea": "Andre", "Marta": "Martita Marita",
}

#: Words that open a sentence of an echo report and are no surname.
SENTENCE_OPENERS = """
Acinesia Acompaña Al Aparece Avisar Av Avenida Bv Calcificación Calle Comentado Comparado Comparar Conclusión Conclusiones
Con Contacto Copia CUIL Cuil De Derrame Deterioro Dilatación Dimensiones Discinesia DNI Doc Documento Domicilio Doppler El
Ella En Engrosamiento Enviar Escala Esclerosis Estudio Firma Flujo Función Grabado Gradiente HC Hipocinesia Hospital
Identidad Imágenes Índice Insuficiencia La Las Lo Los Motilidad No Onda Paciente Para Patrón Pericardio Pje Por Protocolo
Reactivo Realizado Referencia Refiere Reflujo Relación Remitir Resultado Retira Ruta Se Según Serie Sin Sonda Tel Teléfono
Traído Turno Ubicable Un Una Valvas Válvula Ventana Volumen Policlínico Sanatorio Clínica Centro Instituto Maternidad
Laboratorio Unidad Sala Consultas Control
""".split()


def bare(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
